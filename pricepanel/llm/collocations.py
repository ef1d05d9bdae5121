"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are written once as chunks of at most a megabyte, one language each: lower-cased words with one space between
words of a piece and a line end behind a piece, compressed for the way.  A numpy prefix polynomial over a chunk's bytes gives every n-gram
its fingerprint.  A chunk ships its distinct fingerprints, sorted and delta-coded, to the tasks of their ranges; a
fingerprint's chunk and place in the chunk's order is the pointer to its occurrences.  Where the counts of a range
add up to ``min_count``, one bit per pointer goes back to the chunk.  Only these phrases become text: each occurrence
is compared byte for byte with the one that its chunk shows, occurrences that differ are shown on their own, and
the phrases are counted by their text.  So shared fingerprints cost a little work and change no count.

A phrase found ``min_count`` times has parts found as often, so the parts' counts are among the phrases.  Scores are
exact decimals.  What a task holds is bounded by a chunk, or by a range of fingerprints, whose number grows with the
chunks; a phrase in every text is one entry per chunk.

Defined cases: NULL and empty texts have no words; a NULL language is ``und``; repeated rows count each; a piece
longer than a chunk is cut between words, and the next chunk repeats the words that phrases over the cut need, without
counting them again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bytewords import _LOWER, U64, blocks, byte_codes, eights, gathered, same_spans, span_hashes, text_buffer
from .common import shuffle_partitions

CHUNK_BYTES = 1 << 20
#: Of unfinished chunks in a task, all languages together.
OPEN_BYTES = 32 << 20
_BITS = U64(16)  # the lowest bits of a fingerprint stay at home; 48 travel
_CHUNKS = "chunk long, lang string, carry int, words long, text binary"
#: What numpy works on at once within a chunk: bytes hashed, occurrences compared and phrases shown.
_HASH_BYTES, _SHOWN = 1 << 18, 1 << 14

#: What parts pieces, and what parts words.
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[0x0A:0x0E] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


def normalised(buf: np.ndarray) -> np.ndarray:
    """Lower-cased words, each followed by a space, or by a line end if its piece ends there; ``buf`` ends a piece."""
    w = _WORD[buf]
    last = w.copy()
    last[:-1] &= ~w[1:]
    end = np.flatnonzero(last)
    if not len(end):
        return np.zeros(0, np.uint8)
    w[end + 1] = True  # the byte behind a word makes room for its separator
    out = _LOWER[buf[w]]
    sep = np.cumsum(w, dtype=np.int64)[end + 1] - 1
    before = np.cumsum(_BREAK[buf], dtype=np.int64)  # breaks up to each byte
    first = np.flatnonzero(_WORD[buf] & ~np.concatenate([[False], _WORD[buf][:-1]]))
    broken = np.ones(len(end), bool)
    broken[:-1] = before[first[1:]] != before[end[:-1]]
    out[sep] = np.where(broken, 10, 32)
    return out


def _cuts(text: bytes, most: int, carried: int):
    """(part, words repeated) of a normalised text; cut behind a piece, or else between words."""
    at, carry = 0, 0
    while len(text) - at > most:
        cut = text.rfind(b"\n", at, at + most) + 1
        if cut <= at:
            cut = text.rfind(b" ", at, at + most) + 1
            words = text[at:cut].count(b" ")
            if words <= carried + carry:  # nothing new fits: take the next word whole
                nexts = [x for x in (text.find(b" ", at + most), text.find(b"\n", at + most)) if x >= 0]
                cut = min(nexts) + 1 if nexts else len(text)
        yield text[at:cut], carry
        if cut >= len(text):
            return
        if text[cut - 1:cut] == b"\n":
            at, carry = cut, 0
        else:
            back = cut - 1
            for carry in range(1, carried + 1):
                back = max(text.rfind(b" ", at, back), text.rfind(b"\n", at, back))
                if back < 0:
                    break
            at = back + 1 if back >= 0 else at
    yield text[at:], carry


def _squeezed(text: bytes) -> bytes:
    """A text for the way through Spark; rows stay far below its ``CHUNK_BYTES`` there."""
    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _opened(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _chunk_rows(most: int, carried: int):
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        open_: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def row(lang, text, carry=0):
            nonlocal seq
            seq += 1
            words = text.count(b" ") + text.count(b"\n") - carry
            return pa.record_batch([pa.array([(part << 33) + seq]), pa.array([lang]), pa.array([carry], pa.int32()),
                                    pa.array([words]), pa.array([_squeezed(text)], pa.binary())],
                                   names=["chunk", "lang", "carry", "words", "text"])

        def closed(lang):
            size.pop(lang)
            return row(lang, b"".join(open_.pop(lang)))

        for b in batches:
            lang_col = b["lang"].dictionary_encode()
            for code, lang in enumerate(lang_col.dictionary.to_pylist()):
                rows = pc.filter(b["text"], pc.equal(lang_col.indices, code))
                rows = pc.binary_join_element_wise(pc.fill_null(rows, ""), "", "\n")  # a text ends its last piece
                buf, offsets = text_buffer(rows)
                for i, j in blocks(offsets, max(most // 4, 1)):
                    text = normalised(buf[offsets[i]:offsets[j]]).tobytes()
                    if len(text) > most:
                        for piece, carry in _cuts(text, most, carried):
                            yield row(lang, piece, carry)
                        continue
                    if size.get(lang, 0) + len(text) > most:
                        yield closed(lang)
                    open_.setdefault(lang, []).append(text)
                    size[lang] = size.get(lang, 0) + len(text)
                    while sum(size.values()) >= max(OPEN_BYTES, most):
                        yield closed(max(size, key=size.get))
        for lang in list(open_):
            yield closed(lang)
    return run


class _Grams:
    """All n-grams of a chunk that do not leave a piece: spans and fingerprints, shorter ones first."""

    def __init__(self, text: bytes, lang: str, carry: int, max_words: int):
        self.buf = np.frombuffer(text, np.uint8)
        sep = np.flatnonzero((self.buf == 10) | (self.buf == 32))
        start = np.concatenate([[0], sep[:-1] + 1]).astype(np.int64) if len(sep) else np.zeros(0, np.int64)
        piece = np.cumsum(self.buf[sep] == 10) - (self.buf[sep] == 10)  # number of the word's piece
        codes = byte_codes(zlib.crc32(lang.encode("utf-8", "surrogatepass")))
        hashes, starts, ends, sizes = [], [], [], []
        for n in range(1, max_words + 1):
            i = np.arange(max(0, carry - n + 1), len(sep) - n + 1)
            i = i[piece[i] == piece[i + n - 1]]
            starts.append(start[i].astype(np.int32))
            ends.append(sep[i + n - 1].astype(np.int32))
            sizes.append(np.full(len(i), n, np.int8))
            hashes.append(span_hashes(self.buf, start[i], sep[i + n - 1], codes, _HASH_BYTES) >> _BITS)
        self.hash = np.concatenate(hashes)
        self.start, self.end, self.n = np.concatenate(starts), np.concatenate(ends), np.concatenate(sizes)


def _pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 48-bit numbers as gaps in byte planes, and small counts."""
    gaps = np.diff(values, prepend=U64(0))
    wide = 4 if gaps[1:].max(initial=0) < 1 << 32 else 8
    planes = gaps[1:].astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T.tobytes()
    return bytes([wide]) + len(values).to_bytes(4, "little") + int(values[0]).to_bytes(8, "little") + pa.compress(
        planes + counts.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, count_type) -> tuple[np.ndarray, np.ndarray]:
    wide, n = blob[0], int.from_bytes(blob[1:5], "little")
    head, width = (n - 1) * wide, np.dtype(count_type).itemsize
    raw = pa.decompress(blob[13:], decompressed_size=head + n * width, codec="zstd", asbytes=True)
    gaps = np.zeros(n, U64)
    gaps[0] = int.from_bytes(blob[5:13], "little")
    gaps[1:] = np.ascontiguousarray(np.frombuffer(raw, np.uint8, head).reshape(wide, -1).T).view(f"<u{wide}").ravel()
    return np.cumsum(gaps, dtype=U64), np.frombuffer(raw, count_type, n, head)


def _bounds(ranges: int) -> np.ndarray:
    """First fingerprint of each range, and the end."""
    return np.array([(b << 48) // ranges for b in range(ranges + 1)], U64)


def _fingerprints(max_words: int, min_count: int, ranges: int, count_type, read=bytes):
    """A row per chunk and range: the chunk's distinct fingerprints there with their counts, up to ``min_count``."""
    def run(batches):
        bounds = _bounds(ranges)
        for b in batches:
            for k in range(b.num_rows):
                chunk, lang, carry, text = (b[c][k].as_py() for c in ("chunk", "lang", "carry", "text"))
                h = _Grams(read(text), lang, carry, max_words).hash
                h.sort()
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                counts = np.minimum(np.diff(np.append(first, len(h))), min_count).astype(count_type)
                values = h[first]
                at = np.searchsorted(values, bounds)
                full = np.flatnonzero(np.diff(at))
                blobs = [_pack(values[at[r]:at[r + 1]], counts[at[r]:at[r + 1]]) for r in full]
                yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), chunk)),
                                       pa.array(blobs, pa.binary())], names=["range", "chunk", "blob"])
    return run


def _frequent(min_count: int, count_type):
    """Per range: which of each chunk's fingerprints reach ``min_count`` together, a bit each."""
    schema = pa.schema([("chunk", pa.int64()), ("range", pa.int32()), ("bits", pa.binary())])

    def run(key, table):
        values, counts = zip(*(_unpack(x.as_py(), count_type) for x in table["blob"]))
        sizes = [len(v) for v in values]
        values, counts = np.concatenate(values), np.concatenate(counts)
        order = np.argsort(values)
        values = values[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        total = np.add.reduceat(counts[order], first, dtype=np.int64)
        often = np.zeros(len(values), bool)
        often[order] = np.repeat(total >= min_count, np.diff(np.append(first, len(values))))
        out, at = ([], []), 0
        for chunk, size in zip(table["chunk"].to_pylist(), sizes):
            mine = often[at:at + size]
            at += size
            if mine.any():
                out[0].append(chunk)
                out[1].append(np.packbits(mine).tobytes())
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array([key[0].as_py()] * len(out[0]), pa.int32()),
                                     pa.array(out[1], pa.binary())], schema=schema)
    return run


def _phrases(max_words: int, ranges: int, read=bytes):
    """Per chunk: the text and count of every phrase whose fingerprint is frequent."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.string()), ("count", pa.int64())])

    def run(key, table):
        bits = {r: b for r, b in zip(table["range"].to_pylist(), table["bits"].to_pylist()) if b is not None}
        texts = [x for x in zip(*(table[c].to_pylist() for c in ("lang", "carry", "text"))) if x[2] is not None]
        if not texts or not bits:
            return schema.empty_table()
        lang, carry, text = texts[0]
        g = _Grams(read(text), lang, carry, max_words)
        order = np.argsort(g.hash)
        h = g.hash[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(first, len(h)))
        often, at = np.zeros(len(first), bool), np.searchsorted(h[first], _bounds(ranges))
        for r, b in bits.items():
            often[at[r]:at[r + 1]] = np.unpackbits(np.frombuffer(b, np.uint8), count=int(at[r + 1] - at[r]))
        first, size = first[often], size[often]
        del h, g.hash
        total = np.cumsum(size)
        shown = np.repeat(order[first], size)
        each = order[np.repeat(first - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        packed = eights(g.buf)
        length = g.end - g.start
        same = np.empty(len(each), bool)
        for i in range(0, len(each), _SHOWN):
            e, s = each[i:i + _SHOWN], shown[i:i + _SHOWN]
            same[i:i + _SHOWN] = (g.n[e] == g.n[s]) & same_spans(packed, g.start[e], length[e], packed, g.start[s], length[s])
        count = np.add.reduceat(same.astype(np.int64), total - size) if len(size) else np.zeros(0, np.int64)
        other = each[~same]  # another phrase with the fingerprint: shown on its own, counted with the rest later
        show = np.concatenate([order[first], other])
        count = np.concatenate([count, np.ones(len(other), np.int64)])
        spans = [gathered(g.buf, g.start[s], g.end[s]) for s in (show[i:i + _SHOWN] for i in range(0, len(show), _SHOWN))]
        return pa.Table.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(show)), pa.array(g.n[show].astype(np.int32)),
                                     pa.chunked_array(spans, pa.string()), pa.array(count)], schema=schema)
    return run


def frequent_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text",
                     lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f) of all phrases of 1 to ``max_words`` words found ``min_count`` times or more, and (lang, words)."""
    spark = docs.sparkSession
    chunks = cut_lineage(
        docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_chunk_rows(chunk_bytes, max_words - 1), _CHUNKS), "phrase-chunks")
    words = chunks.groupBy("lang").agg(F.sum("words").alias("words"))
    ranges = max(2 * shuffle_partitions(spark), chunks.count() // 6)  # about six chunks' fingerprints in each
    count_type = np.uint8 if min_count < 256 else np.uint32
    bits = (chunks.mapInArrow(_fingerprints(max_words, min_count, ranges, count_type, _opened), "range int, chunk long, blob binary")
            .groupBy("range").applyInArrow(_frequent(min_count, count_type), "chunk long, range int, bits binary"))
    both = chunks.select("chunk", "lang", "carry", "text").unionByName(bits, allowMissingColumns=True)
    shown = both.groupBy("chunk").applyInArrow(_phrases(max_words, ranges, _opened), "lang string, n int, phrase string, count long")
    found = shown.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("f")).filter(F.col("f") >= min_count)
    return cut_lineage(found, "phrases"), words


def cut_score(a, left, right):
    """``floor(1000000 a a / (left right))`` as LONG; exact for counts below 10^15."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right).cast("long")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, swallowed: int = 50,
                 text_col: str = "text", lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words by score: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the lowest-scoring cut, ``n`` all words of the
    language, score ``floor(1000000 a a / (l r))``.  A phrase goes if a longer frequent one around it has
    ``swallowed`` per cent of its count or more.
    """
    found, words = frequent_phrases(docs, max_words, min_count, text_col, lang_col, chunk_bytes)
    candidates = found.filter(F.col("n") >= 2).select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"))
    counts = found.select("lang", F.col("phrase").alias("part"), "f")
    left = counts.withColumnsRenamed({"part": "left", "f": "l"})
    right = counts.withColumnsRenamed({"part": "right", "f": "r"})
    scored = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn(
        "score", cut_score(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.first("a").alias("a"))
    inner = candidates.filter(F.size("w") > 2).select("lang", "a", F.explode(F.expr(
        "array_distinct(flatten(transform(sequence(2, size(w) - 1), s ->"
        " transform(sequence(1, size(w) - s + 1), i -> array_join(slice(w, i, s), ' ')))))")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(swallowed) * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score",
                       F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("salt"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language may hold most phrases: first the best of each of its 64 parts, then the best of these
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.filter(F.col("rank") <= top).join(F.broadcast(words.withColumnRenamed("words", "n")), "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
