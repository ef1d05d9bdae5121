"""A stated set of items (benchmark passages, queries) in blocks of bounded size.

Every document meets every item, so the items go to the tasks; they go in blocks of at most ``most_bytes`` of
text (or one longer item), however large their table is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bytewords import ALNUM, byte_codes, eights, same_spans, span_hashes, text_buffer, word_spans
from .prefix import prefix_sums

ITEM_BYTES = 8 << 20


@dataclass
class Items:
    """One block: its ids, the hashes of all words, the first word of each item, and each distinct word's bytes."""

    ids: list
    words: np.ndarray      # hash of every word, items one after the other
    offsets: np.ndarray    # n + 1 word numbers
    seed: int
    vocab: np.ndarray      # distinct hashes, ascending
    buf: np.ndarray        # bytes of the block
    start: np.ndarray      # of each distinct word in buf
    length: np.ndarray

    def verified(self, v: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each span of ``text`` (as ``eights``) is word ``v`` of the vocabulary, byte for byte."""
        return same_spans(text, starts, ends - starts, eights(self.buf), self.start[v], self.length[v])


def make_items(ids: list, texts: list) -> Items:
    """Words of a block; a hash shared by two different words of it moves on to another seed."""
    buf, offsets = text_buffer(pa.array([t or "" for t in texts], pa.string()))
    starts, ends, counts = word_spans(buf, offsets, ALNUM)
    packed = eights(buf)
    for seed in range(100):  # zero is no word's hash, and no two words share one
        h = span_hashes(buf, starts, ends, byte_codes(seed))
        vocab, first, which = np.unique(h, return_index=True, return_inverse=True)
        first = first.astype(np.int64)
        lens = ends - starts
        if not len(vocab) or (vocab[0] and same_spans(packed, starts, lens, packed, starts[first][which], lens[first][which]).all()):
            break
    else:
        raise RuntimeError("no seed tells the words apart")
    return Items(ids, h, np.concatenate([[0], np.cumsum(counts)]), seed, vocab, buf, starts[first], lens[first])


def item_blocks(items: DataFrame, id_col: str, text_col: str, most_bytes: int = ITEM_BYTES) -> Iterator[Items]:
    """The blocks one after the other, each of bounded size in the driver."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        (F.octet_length(F.coalesce(text_col, F.lit(""))) + 16).cast("long").alias("size"))
    order = [F.col("id").asc_nulls_last(), F.md5(F.coalesce("text", F.lit("")))]
    placed, _ = prefix_sums(rows, order, {"size": "before"}, "items")
    placed = cut_lineage(placed.select("id", "text", F.floor(F.col("before") / most_bytes).alias("block")), "item-blocks")
    last = placed.agg(F.max("block")).first()[0]
    for b in range(0 if last is None else int(last) + 1):
        got = placed.filter(F.col("block") == b).select("id", "text").collect()
        if got:
            got.sort(key=lambda r: (r.id is None, r.id if r.id is not None else 0, r.text or ""))
            yield make_items([r.id for r in got], [r.text for r in got])
