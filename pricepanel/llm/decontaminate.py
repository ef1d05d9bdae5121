"""Benchmark decontamination by suffix arrays over the training words.

Each task makes shards of about a million words of its documents: every word becomes a 64-bit letter, and the
shard's word positions are sorted by the letters that follow them (rank tripling, only tied suffixes are sorted
again, down to the longest item).  Every suffix of every item is binary-searched in each shard, letter by letter
for all suffixes at once: the range shrinks until no suffix of the shard follows, which gives the longest verbatim
match and where it stands, and on the way the range of all occurrences of the item's window.  Words hit are
compared with the item's bytes; a letter that stands for another word is taken out and the shard sorted anew, so
the result does not rest on hashes.

Documents are never shuffled: the items come to them, in blocks of bounded size (``items.item_blocks``), one
``mapInArrow`` after the other.  A document longer than a shard is cut into shards that overlap by the longest item.

Defined cases: NULL or empty texts have no words; an item without words has no window; an item of fewer words than
the window is one window; repeated item ids count as one item, whose windows are those of all its rows; an item
with a NULL id hits words but is not counted or listed; repeated rows get the same result each; an empty table on
either side gives an empty result or no hits; input columns named like result columns are replaced by them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from .bytewords import ALNUM, U64, blocks, byte_codes, eights, span_hashes, text_buffer, word_spans
from .items import Items, item_blocks

SHARD_WORDS = 1_000_000
#: Bytes of text made into words at a time (or one longer document).
TEXT_BYTES = 8 << 20
_END = U64(0)  # after each document; no word has this letter


def suffix_array(letters: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` letters (or more) from each on; ties keep any order."""
    n = len(letters)
    order = np.argsort(letters).astype(np.int64)
    rank = np.zeros(n + 1, np.int64)  # of the group of equal suffixes, from 1; 0 beyond the end
    tied, step = np.arange(n), 1
    key = letters[order]
    bits = int(n + 1).bit_length()
    ways = 3 if 3 * bits <= 63 else 2
    if 2 * bits > 63:
        raise ValueError("shard too large")
    while len(tied):
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (tied[1:] != tied[:-1] + 1)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(tied)))
        rank[order[tied]] = np.repeat(tied[first], size) + 1
        if step >= depth:
            break
        tied = tied[np.repeat(size > 1, size)]
        at = order[tied]
        key = rank[at]
        for k in range(1, ways):
            key = (key << bits) | rank[np.minimum(at + k * step, n)]
        again = np.argsort(key)
        order[tied], key = at[again], key[again]
        step *= ways
    return order


def search_suffixes(letters: np.ndarray, order: np.ndarray, items: Items, need: np.ndarray):
    """For every suffix of every item: longest match, one place of it, and the range with ``need`` letters.

    ``letters`` ends with ``_END``.  The range is empty where the match is shorter than ``need`` (0: not asked for).
    """
    m, n = len(items.words), len(order)
    end = np.repeat(items.offsets[1:], np.diff(items.offsets))
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    longest, place = np.zeros(m, np.int64), np.full(m, -1, np.int64)
    from_, to = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live, depth = np.arange(m), 0
    while len(live):
        target = items.words[live + depth]

        def bound(right):
            a, b = low[live].copy(), high[live].copy()
            open_ = np.flatnonzero(a < b)
            while len(open_):
                mid = (a[open_] + b[open_]) >> 1
                there = letters[np.minimum(order[mid] + depth, n - 1)]
                up = (there <= target[open_]) if right else (there < target[open_])
                a[open_[up]] = mid[up] + 1
                b[open_[~up]] = mid[~up]
                open_ = open_[a[open_] < b[open_]]
            return a

        low[live], high[live] = bound(False), bound(True)
        live = live[low[live] < high[live]]
        depth += 1
        longest[live], place[live] = depth, order[low[live]]
        full = live[need[live] == depth]
        from_[full], to[full] = low[full], high[full]
        live = live[live + depth < end[live]]
    return longest, place, from_, to


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] of them), one after the other."""
    total = np.cumsum(count)
    return np.repeat(first - (total - count), count) + np.arange(total[-1] if len(total) else 0)


class _Shard:
    """Words of consecutive documents (or of a part of one), each document closed by ``_END``."""

    def __init__(self, buf, starts, ends, counts, hashes, items: Items, window: int):
        self.items = items
        rows = len(counts)
        at = np.arange(len(starts)) + np.repeat(np.arange(rows), counts)  # letter number of each word
        n = len(starts) + rows
        letters = np.zeros(n, U64)
        letters[at] = hashes
        row = np.repeat(np.arange(rows), counts + 1)
        item_len = np.diff(items.offsets)
        left = np.repeat(items.offsets[1:], item_len) - np.arange(len(items.words))
        whole = np.repeat(item_len, item_len)
        need = np.where(left >= window, window, np.where((whole < window) & (left == whole), whole, 0))
        depth = int(item_len.max()) if len(item_len) else 0
        where = np.zeros(n, np.int64)
        where[at] = np.arange(len(starts))
        packed = eights(buf)
        while True:
            order = suffix_array(letters, depth)
            self.longest, self.place, low, high = search_suffixes(letters, order, items, need)
            hit = np.flatnonzero(high > low)
            mine = np.repeat(np.arange(len(item_len)), item_len)[hit]
            hit = hit[np.unique(mine * (n + 1) + low[hit], return_index=True)[1]]  # a window once an item
            mine, count = np.repeat(np.arange(len(item_len)), item_len)[hit], (high - low)[hit]
            begin = order[_ranges(low[hit], count)]
            size, item = np.repeat(need[hit], count), np.repeat(mine, count)
            marks = np.zeros(n + 1, np.int64)
            np.add.at(marks, begin, 1)
            np.add.at(marks, begin + size, -1)
            covered = np.cumsum(marks)[:n] > 0
            best = self.longest > 0  # the reported places are compared too
            shown = np.zeros(n + 1, np.int64)
            np.add.at(shown, self.place[best], 1)
            np.add.at(shown, self.place[best] + self.longest[best], -1)
            check = np.flatnonzero(covered | (np.cumsum(shown)[:n] > 0))
            word = where[check]
            v = np.searchsorted(items.vocab, letters[check])
            wrong = check[~items.verified(v, packed, starts[word], ends[word])]
            if not len(wrong):
                break
            letters[wrong] = _END
        self.covered = covered[at]                # of each word
        self.row_of_place = row[self.place]
        self.word_of_place = where[self.place]
        pairs = np.unique(row[begin] * len(items.ids) + item) if len(begin) else np.zeros(0, np.int64)
        self.pairs = [(int(p) // len(items.ids), int(p) % len(items.ids)) for p in pairs]


def _shards(column, items: Items, window: int, shard_words: int) -> Iterator[tuple[int, np.ndarray, int, int, _Shard]]:
    """(first row, words of each row, first word of the row, its words passed over, shard) of a text column.

    Whole documents share a shard; a longer one is cut, each part repeating the last words of the one before.
    """
    buf, offsets = text_buffer(column)
    codes = byte_codes(items.seed)
    overlap = max(window, int(np.diff(items.offsets).max(initial=1))) - 1
    most = max(shard_words, 2 * overlap + 2)
    for i, j in blocks(offsets, TEXT_BYTES, shard_words):
        text, off = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, counts = word_spans(text, off, ALNUM)
        hashes = span_hashes(text, starts, ends, codes)
        first = np.concatenate([[0], np.cumsum(counts)])
        for a, b in blocks(first, most):
            begin = int(first[a])
            while True:
                stop = min(int(first[b]), begin + most)
                part = counts[a:b] if b - a > 1 else np.array([stop - begin])
                yield i + a, counts[a:b], int(first[a]), begin - int(first[a]), _Shard(
                    text, starts[begin:stop], ends[begin:stop], part, hashes[begin:stop], items, window)
                if stop == first[b]:
                    break
                begin = stop - overlap


def _row_hits(column, items: Items, window: int, shard_words: int):
    """(row, words, hit flags, item numbers) of every row in order."""
    n_words, hits, found = None, None, None
    last = -1
    for row, counts, _, begin, shard in _shards(column, items, window, shard_words):
        if begin == 0:
            if last >= 0:
                yield last, n_words, hits, found
            last, n_words = row, counts
            hits, found = np.zeros(int(counts.sum()), bool), [set() for _ in counts]
        hits[begin:begin + len(shard.covered)] |= shard.covered
        for r, item in shard.pairs:
            found[r].add(item)
    if last >= 0:
        yield last, n_words, hits, found


_HITS, _IDS = "__dc_hits", "__dc_items"


def _add_block(text_col: str, items: Items, window: int, shard_words: int):
    """Adds this block's hits (packed bits, NULL for none) and item ids to those of the blocks before."""
    def run(batches):
        for b in batches:
            hits, ids = b[_HITS].to_pylist(), b[_IDS].to_pylist()
            for row, counts, flags, found in _row_hits(b[text_col], items, window, shard_words):
                at = np.concatenate([[0], np.cumsum(counts)])
                any_ = np.add.reduceat(np.append(flags, False).astype(np.int64), at[:-1]) * (counts > 0)
                for k in np.flatnonzero(any_):
                    mine = flags[at[k]:at[k + 1]]
                    if hits[row + k] is not None:
                        mine = mine | np.unpackbits(np.frombuffer(zlib.decompress(hits[row + k]), np.uint8),
                                                    count=len(mine)).astype(bool)
                    hits[row + k] = zlib.compress(np.packbits(mine).tobytes(), 1)
                    ids[row + k] = sorted({*(ids[row + k] or ()), *(items.ids[x] for x in found[k] if items.ids[x] is not None)})
            cols = {_HITS: pa.array(hits, pa.binary()), _IDS: pa.array(ids, pa.list_(pa.string()))}
            yield pa.record_batch([cols.get(n, b[n]) for n in b.schema.names], names=b.schema.names)
    return run


_RESULT = [("n_words", LongType(), pa.int64()), ("n_hit", LongType(), pa.int64()), ("n_items", LongType(), pa.int64()),
           ("items_sha256", StringType(), pa.string()), ("contaminated", BooleanType(), pa.bool_()),
           ("item_ids", ArrayType(StringType()), pa.list_(pa.string()))]


def _finish(text_col: str, keep: list[str]):
    def run(batches):
        for b in batches:
            buf, offsets = text_buffer(b[text_col])
            n_words = np.zeros(b.num_rows, np.int64)
            for i, j in blocks(offsets, TEXT_BYTES):
                n_words[i:j] = word_spans(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ALNUM)[2]
            n_hit = [0 if h is None else int(np.unpackbits(np.frombuffer(zlib.decompress(h), np.uint8)).sum())
                     for h in b[_HITS].to_pylist()]
            ids = [x or [] for x in b[_IDS].to_pylist()]
            out = (n_words, n_hit, [len(x) for x in ids], [hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids],
                   [h > 0 for h in n_hit], ids)
            yield pa.record_batch([b[n] for n in keep] + [pa.array(v, t) for v, (_, _, t) in zip(out, _RESULT)],
                                  names=[*keep, *(n for n, _, _ in _RESULT)])
    return run


def _chained(*steps):
    """One task function out of several that pass record batches on."""
    def run(batches):
        for s in steps:
            batches = s(batches)
        yield from batches
    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, keep: list[str] | None = None,
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """Columns ``keep`` of the documents (default all) and what of them stands in the items.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``n_items``, ``item_ids`` (sorted as strings),
    ``items_sha256`` (of the ids joined by commas) and ``contaminated``.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {n for n, _, _ in _RESULT}]
    inner = docs.select(*keep, F.col(text_col).alias("__dc_text"), F.lit(None).cast("binary").alias(_HITS),
                        F.lit(None).cast("array<string>").alias(_IDS))
    schema = inner.schema
    block_rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    step = None
    for block in item_blocks(block_rows, "i", "t"):
        if step is not None:
            inner = inner.mapInArrow(step, schema)
        step = _add_block("__dc_text", block, window, shard_words)
    out = StructType([*(schema[c] for c in keep), *(StructField(n, t) for n, t, _ in _RESULT)])
    done = _finish("__dc_text", keep)
    return inner.mapInArrow(done if step is None else _chained(step, done), out)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, **options) -> DataFrame:
    """The documents without any that holds a window of an item; their columns stay as they are."""
    names = {c: f"__dc_{i}" for i, c in enumerate(docs.columns)}
    text = options.pop("text_col", "text")
    flagged = contamination(docs.withColumnsRenamed(names), items, window, text_col=names[text], **options)
    return flagged.filter(~F.col("contaminated")).select(*[F.col(n).alias(c) for c, n in names.items()])


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The longest verbatim match of every item suffix in the documents, and one place where it stands.

    One row per (item_id, suffix) that matches at least one word: ``length`` in words, the document's id and the
    match's first word in it; ties go to the smallest id, then the first word.  A row per suffix and shard is
    shuffled, never text.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "item_id string, suffix long, length long, doc_id long, word long"

    def places(block: Items):
        def run(batches):
            number = np.arange(len(block.words)) - np.repeat(block.offsets[:-1], np.diff(block.offsets))
            item = np.repeat(np.arange(len(block.ids)), np.diff(block.offsets))
            for b in batches:
                ids = b["id"].to_pylist()
                for row, counts, _, begin, s in _shards(b["text"], block, 1, shard_words):
                    first = np.concatenate([[0], np.cumsum(counts)])
                    k = np.flatnonzero(s.longest)
                    r = s.row_of_place[k]
                    yield pa.record_batch([
                        pa.array([block.ids[x] for x in item[k]], pa.string()), pa.array(number[k]), pa.array(s.longest[k]),
                        pa.array([ids[row + x] for x in r], pa.int64()), pa.array(s.word_of_place[k] + begin - first[r])],
                        names=["item_id", "suffix", "length", "doc_id", "word"])
        return run

    out = None
    for block in item_blocks(items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")), "i", "t"):
        part = texts.mapInArrow(places(block), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max_by(F.struct("length", "doc_id", "word"),
                    F.struct("length", (-F.col("doc_id")).alias("d"), (-F.col("word")).alias("w")))
    return out.groupBy("item_id", "suffix").agg(best.alias("b")).select("item_id", "suffix", "b.length", "b.doc_id", "b.word")
