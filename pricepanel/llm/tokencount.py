"""Exact token counts by a finite-state tokenizer compiled from a public BPE vocabulary file.

Byte-pair encoding of a word can be read from left to right: the last token of each prefix's encoding
is the one vocabulary token that ends there, encodes to itself, and stays apart from the last token
before it when the two are encoded together.  So a state needs only the starts from which a token may
still be under way, each with the last token before it and the tokens emitted since.  These states form
a deterministic transducer over bytes (with a word's last byte marked); each transition is annotated
with the tokens it emits, negative where earlier bytes are merged.  Transitions are compiled when first
met and kept per worker process, never more than ``MAX_STATES`` states: where one more is asked for, the table
starts anew and a shorter part of the stream is tried, whatever the text.

Texts of a batch become one byte stream, cut into equal chunks that all advance in lockstep.  A chunk's
state map is constant from its first word end on, so every chunk starts there at once.  A chunk inside one long
word is run from a fresh start some bytes before it, and its path of states is kept: its map sends every state whose
own path meets that one to the same end with the same tokens from there on.  The prefix scan applies the maps in
turn, following an incoming state only until the paths meet, and each chunk then finishes the word cut in two.

Defined cases: NULL and empty texts have no bytes and no tokens; special strings inside a text count one
token each (the library's default); rows are counted one by one, repeated or not; other columns are
passed on untouched (columns of the output's names are replaced); an empty table gives an empty result.  Character
classes and lower case are those of Python's Unicode tables; a letter that only a newer Unicode knows may
be handled otherwise than by the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import segments

END = 256          # added to a word's last byte
MAX_STATES = 140_000
MAX_PAIRS = 400_000  # remembered answers of the encoder
CHUNK = 256        # bytes that a lane advances
RUN_IN = 32        # bytes before a chunk without a word end from which its path starts
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The pre-tokenizer's contractions after an apostrophe, and Unicode's white space.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def char_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            table[c] = LETTER if kind == "L" else NUMBER
    table[WHITE] = SPACE
    return table


def byte_chars() -> list[str]:
    """The vocabulary's character for each byte: itself if printable Latin-1, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Full(Exception):
    """One state more than the table may have."""


class Transducer:
    """States and transitions of one vocabulary, compiled on demand."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model.get("dropout"):
            raise ValueError("only byte-level BPE vocabularies with word ends can be compiled")
        byte_of = {c: b for b, c in enumerate(byte_chars())}

        def symbols(token: str) -> tuple:
            end = token.endswith("</w>") and len(token) > 4
            body = [byte_of[c] for c in (token[:-4] if end else token)]
            return (*body[:-1], body[-1] + END) if end else tuple(body)

        self.special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        names = {t: symbols(t) for t in model["vocab"]}
        self.tokens = set(names.values())
        self.prefixes = {s[:i] for s in self.tokens for i in range(1, len(s))}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(names[a], names[b]): r for r, (a, b) in enumerate(merges)}
        self.apart_memo: dict = {}
        self.columns = np.full(512, -1, np.int64)
        self.width, self.used = 128, 0
        self.reset()

    def reset(self):
        self.apart_memo.clear()
        self.states, self.number = [], {}
        self.next = np.full((32768, self.width), -1, np.int32)
        self.emit = np.zeros((32768, self.width), np.int16)
        self.add(((0, None, 0),), ())

    def add(self, starts: tuple, tail: tuple) -> int:
        """``tail``: bytes since the longest live start; ``starts``: (bytes since, last token before, tokens since)."""
        key = (starts, tail)
        n = self.number.get(key)
        if n is None:
            if len(self.states) >= MAX_STATES:
                raise _Full
            n = self.number[key] = len(self.states)
            self.states.append(key)
            if n >= len(self.next):
                grow = ((0, 32768), (0, 0))
                self.next = np.pad(self.next, grow, constant_values=-1)
                self.emit = np.pad(self.emit, grow)
        return n

    def encode(self, symbols: tuple) -> list[tuple]:
        """Plain byte-pair encoding: lowest rank first, leftmost among equals."""
        parts = [(s,) for s in symbols]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def apart(self, left, token) -> bool:
        key = (left, token)
        got = self.apart_memo.get(key)
        if got is None:
            if len(self.apart_memo) >= MAX_PAIRS:
                self.apart_memo.clear()
            want = [token] if left is None else [left, token]
            got = self.apart_memo[key] = self.encode((left or ()) + token) == want
        return got

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        starts, tail = self.states[state]
        live = []
        for back, last, since in starts:
            seen = tail[len(tail) - back:] + (symbol,)
            if seen in self.tokens and self.apart(None, seen) and (last is None or self.apart(last, seen)):
                now = seen, since
                break
        else:
            raise ValueError(f"no token ends at {tail + (symbol,)}")
        token, since = now
        delta = 1 - since
        if symbol >= END:
            return 0, delta
        for back, last, s in starts:
            seen = tail[len(tail) - back:] + (symbol,)
            if seen in self.prefixes:
                live.append((back + 1, last, s + delta))
        live.append((0, token, 0))
        return self.add(tuple(live), (tail + (symbol,))[len(tail) + 1 - live[0][0]:]), delta

    def column(self, symbols: np.ndarray) -> np.ndarray:
        """Table columns of the symbols; new ones are added."""
        cols = self.columns[symbols]
        if (cols < 0).any():
            for s in np.unique(symbols[cols < 0]):
                if self.used == self.width:
                    wider = ((0, 0), (0, 128))
                    self.next = np.pad(self.next, wider, constant_values=-1)
                    self.emit = np.pad(self.emit, wider)
                    self.width += 128
                self.columns[s] = self.used
                self.used += 1
            cols = self.columns[symbols]
        return cols

    def advance(self, states: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = states * self.width + cols
        new = self.next.ravel()[at]
        if (new < 0).any():
            symbol_of = np.zeros(self.width, np.int64)
            known = np.flatnonzero(self.columns >= 0)
            symbol_of[self.columns[known]] = known
            for x in np.unique(at[new < 0]).tolist():
                s, c = divmod(x, self.width)
                to, delta = self.step(s, int(symbol_of[c]))
                self.next[s, c], self.emit[s, c] = to, delta
            new = self.next.ravel()[at]
        return new.astype(np.int64), self.emit.ravel()[at]

    def follow(self, state: int, col: int) -> tuple[int, int]:
        """One transition."""
        to = int(self.next[state, col])
        if to < 0:
            to, delta = self.step(state, int(np.flatnonzero(self.columns == col)[0]))
            self.next[state, col], self.emit[state, col] = to, delta
        return to, int(self.emit[state, col])

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens emitted at each symbol of a stream of whole words (the last symbol ends a word)."""
        n = len(symbols)
        out, ends = np.empty(n, np.int16), np.flatnonzero(symbols >= END)
        at, size, within = 0, n, None  # within: the state inside a word that was cut
        while at < n:
            stop = min(n, at + size)
            if stop < n:
                k = int(np.searchsorted(ends, stop))
                stop = int(ends[k - 1]) + 1 if k and ends[k - 1] >= at else stop
            try:
                first = 0 if within is None else self.add(*within)
                out[at:stop], last = self._part(symbols[at:stop], first)
            except _Full:
                self.reset()
                size = max(CHUNK, (stop - at) // 4)
                continue
            within = None if symbols[stop - 1] >= END else self.states[last]
            at = stop
            if len(self.states) < MAX_STATES // 4:
                size *= 2
        return out

    def _part(self, symbols: np.ndarray, first: int) -> tuple[np.ndarray, int]:
        """Tokens emitted at each symbol from state ``first`` on, and the state at the end."""
        n, cols = len(symbols), self.column(symbols)
        lanes = -(-n // CHUNK)
        pad = lanes * CHUNK - n
        grid = np.pad(cols, (0, pad)).reshape(lanes, CHUNK).T.copy()
        ends = np.pad(symbols >= END, (0, pad)).reshape(lanes, CHUNK)
        synced = ends.any(axis=1)
        synced[0] = True
        head = np.where(ends.any(axis=1), ends.argmax(axis=1) + 1, CHUNK)  # bytes that depend on the incoming state
        head[0] = 0
        size = np.full(lanes, CHUNK)
        size[-1] = CHUNK - pad
        out = np.zeros((CHUNK, lanes), np.int16)
        state = np.zeros(lanes, np.int64)
        state[0] = first
        for p in range(CHUNK):  # every chunk from its first word end on
            on = np.flatnonzero((head <= p) & (p < size))
            if len(on) == lanes:
                state, out[p] = self.advance(state, grid[p])
            elif len(on):
                state[on], out[p, on] = self.advance(state[on], grid[p, on])
        inside = np.flatnonzero(~synced)
        if len(inside):
            path, now = np.empty((CHUNK, len(inside)), np.int64), np.zeros(len(inside), np.int64)
            for p in range(CHUNK - RUN_IN, CHUNK):
                now, _ = self.advance(now, grid[p, inside - 1])
            for p in range(CHUNK):
                path[p] = now
                on = np.flatnonzero(p < size[inside])
                now[on], out[p, inside[on]] = self.advance(now[on], grid[p, inside[on]])
            for k, lane in enumerate(inside.tolist()):  # the scan: a chunk's outgoing state is the next one's incoming state
                s, p = int(state[lane - 1]), 0
                while p < size[lane] and s != path[p, k]:
                    s, out[p, lane] = self.follow(s, int(grid[p, lane]))
                    p += 1
                state[lane] = s if p == size[lane] else now[k]
        later = np.flatnonzero(synced)
        later = later[later > 0]
        now, length = state[later - 1], np.minimum(head[later], size[later])
        for p in range(int(length.max(initial=0))):
            on = np.flatnonzero(p < length)
            now[on], out[p, later[on]] = self.advance(now[on], grid[p, later[on]])
        return out.T.reshape(-1)[:n], int(state[-1])

    def count(self, texts: list) -> np.ndarray:
        """Token counts of the texts (None: empty)."""
        counts = np.zeros(len(texts), np.int64)
        special = re.compile("|".join(self.special)) if self.special else None
        clean = []
        for i, t in enumerate(texts):
            t = t or ""
            if special and "<|" in t:
                t, counts[i] = special.subn(" ", t)
            if not t.isascii():
                t = unicodedata.normalize("NFC", t).replace("Σ", "σ")
            clean.append(t.lower())
        joined = "\n".join([*clean, ""])
        lens = np.fromiter((len(t) + 1 for t in clean), np.int64, len(clean))
        raw = np.frombuffer(joined.encode("utf-8"), np.uint8)
        if len(raw) == len(joined):
            points, char_of = raw, None
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
        kinds = char_classes()[points]
        after = np.append(kinds[1:], SPACE)
        final = (kinds == NUMBER) | (kinds != after)
        self._contractions(points, kinds, after, final)
        if char_of is None:
            symbols, keep = raw.astype(np.int64) + END * final, kinds != SPACE
            doc_of = np.repeat(np.arange(len(clean)), lens)
        else:
            ends = np.append((raw[1:] & 0xC0) != 0x80, True)
            symbols, keep = raw.astype(np.int64) + END * (final[char_of] & ends), (kinds != SPACE)[char_of]
            doc_of = np.repeat(np.arange(len(clean)), lens)[char_of]
        emitted = self.run(symbols[keep])
        counts += np.bincount(doc_of[keep], weights=emitted, minlength=len(texts)).astype(np.int64)
        return counts

    @staticmethod
    def _contractions(points, kinds, after, final) -> None:
        """An apostrophe that starts a piece takes a following contraction along."""
        before = np.insert(kinds[:-1], 0, SPACE)
        at = np.flatnonzero((points == ord("'")) & (before != OTHER) & (after == LETTER))
        padded = np.append(points, [0, 0])
        for s in SUFFIXES:
            hit = at[np.all([padded[at + 1 + i] == ord(c) for i, c in enumerate(s)], axis=0)]
            final[hit] = False
            final[hit + len(s)] = True


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _count_rows(path: str, batch_chars: int = 3_000_000):
    def run(batches):
        machine = transducer(path)
        for b in batches:
            got, part, at, size = np.zeros(b.num_rows, np.int64), [], [], 0
            for i, t in enumerate(b["_tc_text"]):
                for s in segments(t.as_py() or "", batch_chars):  # white space parts tokens, so counts add up
                    part.append(s)
                    at.append(i)
                    size += len(s)
                    if size >= batch_chars:
                        np.add.at(got, at, machine.count(part))
                        part, at, size = [], [], 0
            if part:
                np.add.at(got, at, machine.count(part))
            names = [n for n in b.schema.names if n != "_tc_text"]
            yield pa.record_batch([*[b[n] for n in names], pa.array(got, pa.int64())], names=[*names, "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """All columns but the text, with ``n_bytes`` (UTF-8) and ``n_tokens`` by the vocabulary at ``path``."""
    rest = [c for c in docs.columns if c not in (text_col, "n_bytes", "n_tokens")]
    ready = docs.select(*rest, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                        F.col(text_col).alias("_tc_text"))
    schema = StructType([f for f in ready.schema.fields if f.name != "_tc_text"] + [StructField("n_tokens", LongType())])
    return ready.mapInArrow(_count_rows(path), schema)
