"""Ranked lexical search by hashed max-sketches.

A document's terms have integer impacts (term frequency damped by the document's length).  A sketch folds them all
into ``slots`` numbers: a term's hash names its slot, and a slot keeps the largest impact that falls into it.  A
query term therefore finds in its slot at least the impact it has in the document, and the weighted sum of the slots
of a query is an upper bound of the score.  Documents are taken by block: one lookup of the query's slots gives the
bounds of the whole block, documents are scored exactly in the order of falling bounds, and the scoring ends where
the bound drops below the score that the last of the ``k`` best so far has.  Exact scores read the document's own
terms and compare every occurrence with the query term's bytes, so hashes decide nothing.

Queries come in blocks of bounded size (``items.item_blocks``) to every task; a task returns its ``k`` best for each
query, and a window over these rows ranks them.  Texts are never shuffled.

Defined cases: NULL texts and texts without a term count in nothing and are never found; a query without terms finds
nothing; repeated rows are documents of their own with equal scores; a NULL id stands behind all others; a repeated
query row is answered again; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import ALNUM, U64, blocks, byte_codes, eights, span_hashes, text_buffer, word_spans
from .items import Items, item_blocks

#: Slots of a sketch (a power of two).
SLOTS = 4096
TEXT_BYTES = 8 << 20
BLOCK_ROWS = 2048
#: Documents scored between two looks at the bound.
STEP = 32
_HASH_BITS = 48  # of a term, below the document's number in the block


def _term_counts(items: Items):
    """Over texts: (NULL, documents with terms, terms) once a task, and (vocabulary number, documents) of the block's terms."""
    def run(batches):
        codes = byte_codes(items.seed)
        docs = terms = 0
        df = np.zeros(len(items.vocab), np.int64)
        for b in batches:
            buf, offsets = text_buffer(b["text"])
            for i, j in blocks(offsets, TEXT_BYTES):
                text, off = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, counts = word_spans(text, off, ALNUM)
                docs += int((counts > 0).sum())
                terms += len(starts)
                h = span_hashes(text, starts, ends, codes)
                v, at = _in_vocab(items, h)
                doc = np.repeat(np.arange(j - i), counts)[at]
                real = items.verified(v, eights(text), starts[at], ends[at])
                pairs = np.unique(doc[real] * len(df) + v[real])
                df += np.bincount(pairs % max(1, len(df)), minlength=len(df))
        found = np.flatnonzero(df)
        yield pa.record_batch([pa.array([None, *found.tolist()], pa.int32()), pa.array([docs, *df[found].tolist()], pa.int64()),
                               pa.array([terms, *[0] * len(found)], pa.int64())], names=["term", "docs", "terms"])
    return run


def _in_vocab(items: Items, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary number, position) of the hashes that the block has."""
    if not len(items.vocab):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    v = np.minimum(np.searchsorted(items.vocab, h), len(items.vocab) - 1)
    at = np.flatnonzero(items.vocab[v] == h)
    return v[at], at


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class _Block:
    """Sorted terms, impacts and sketches of consecutive documents."""

    def __init__(self, text, starts, ends, counts, hashes, n_docs: int, n_terms: int, slots: int):
        self.packed, self.starts, self.ends = eights(text), starts, ends
        rows = len(counts)
        doc = np.repeat(np.arange(rows), counts).astype(U64)
        key = (doc << U64(_HASH_BITS)) | (hashes >> U64(64 - _HASH_BITS))
        self.order = np.argsort(key)
        key = key[self.order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        self.first = np.flatnonzero(new)
        self.key = key[self.first]
        self.tf = np.diff(np.append(self.first, len(key)))
        self.m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in counts], np.int64)  # in whole numbers of any size
        of = (self.key >> U64(_HASH_BITS)).astype(np.int64)
        sketch = np.zeros(slots * rows, np.int64)
        np.maximum.at(sketch, slot_of(self.key, slots) * rows + of, impacts(self.tf, self.m[of]))
        self.sketch = sketch.reshape(slots, rows)

    def score(self, docs: np.ndarray, items: Items, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of the documents for a query's distinct vocabulary numbers and weights."""
        hashes = items.vocab[terms] >> U64(64 - _HASH_BITS)
        want = (docs.astype(U64)[:, None] << U64(_HASH_BITS)) | hashes[None, :]
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        d, t = np.nonzero(self.key[at] == want)
        run = at[d, t]
        tf = self.tf[run]
        total = np.cumsum(tf)
        pair = np.repeat(np.arange(len(run)), tf)
        word = self.order[np.repeat(self.first[run] - (total - tf), tf) + np.arange(total[-1] if len(total) else 0)]
        real = items.verified(terms[t][pair], self.packed, self.starts[word], self.ends[word])
        tf = np.bincount(pair[real], minlength=len(run))
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, d, weights[t] * impacts(tf, self.m[docs[d]]))
        return out


def slot_of(key: np.ndarray, slots: int) -> np.ndarray:
    return (key & U64(slots - 1)).astype(np.int64)


class _Best:
    """The k best (score, id) of one query so far; NULL ids behind all others."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """What a document's bound must reach: a tie may still win by its id."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score, ids, null):
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        best = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[best], ids[best], null[best]


def _search(items: Items, queries: list, n_docs: int, n_terms: int, k: int, slots: int):
    """Over (id, text): the task's k best of each query, as (query number, id, score)."""
    def run(batches):
        codes = byte_codes(items.seed)
        best = [_Best(k) for _ in queries]
        looks = [slot_of(items.vocab[t] >> U64(64 - _HASH_BITS), slots) for t, _ in queries]
        for b in batches:
            buf, offsets = text_buffer(b["text"])
            all_null = b["id"].is_null().to_numpy(zero_copy_only=False)
            all_ids = b["id"].fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in blocks(offsets, TEXT_BYTES, BLOCK_ROWS):
                text, off = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, counts = word_spans(text, off, ALNUM)
                if not len(starts):
                    continue
                block = _Block(text, starts, ends, counts, span_hashes(text, starts, ends, codes), n_docs, n_terms, slots)
                ids, null = all_ids[i:j], all_null[i:j]
                for (terms, weights), look, top in zip(queries, looks, best):
                    if not len(terms):
                        continue
                    bound = weights @ block.sketch[look]
                    able = np.flatnonzero(bound >= top.least())
                    able = able[np.argsort(-bound[able], kind="stable")]
                    for s in range(0, len(able), STEP):
                        docs = able[s:s + STEP]
                        docs = docs[bound[docs] >= top.least()]
                        if not len(docs):
                            break
                        score = block.score(docs, items, terms, weights)
                        good = score > 0
                        top.add(score[good], ids[docs[good]], null[docs[good]])
        for q, top in enumerate(best):
            if len(top.score):
                yield pa.record_batch([pa.array(np.full(len(top.score), q, np.int32)), pa.array(top.id, mask=top.null),
                                       pa.array(top.score)], names=["query", "id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", slots: int = SLOTS) -> DataFrame:
    """The ``k`` best documents of every item: item id, ``rank`` from 1, document id, ``score`` (LONG, above 0)."""
    if slots & (slots - 1) or slots > 1 << 30:
        raise ValueError("slots must be a power of two")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for number, block in enumerate(item_blocks(items, item_id, item_text)):
        stats = {r.term: (r.docs, r.terms) for r in texts.select("text").mapInArrow(
            _term_counts(block), "term int, docs long, terms long").groupBy("term").agg(
                F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect()}  # a row per term of the block
        n_docs, n_terms = stats.get(None, (0, 0))
        if not n_docs:
            continue
        df = np.array([stats.get(t, (0, 0))[0] for t in range(len(block.vocab))], np.int64)
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        queries = []
        for a, b in zip(block.offsets, block.offsets[1:]):
            terms, n = np.unique(np.searchsorted(block.vocab, block.words[a:b]), return_counts=True)
            used = (df[terms] > 0) & (w[terms] > 0)
            queries.append((terms[used], (n * w[terms])[used]))
        part = texts.mapInArrow(_search(block, queries, n_docs, n_terms, k, slots), "query int, id long, score long")
        names = docs.sparkSession.createDataFrame(
            [(q, x) for q, x in enumerate(block.ids)], f"query int, item {items.schema[item_id].dataType.simpleString()}")
        part = part.join(F.broadcast(names), "query").select(F.lit(number).alias("block"), "query", "item", "id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame(
            [], f"block int, query int, item {items.schema[item_id].dataType.simpleString()}, id long, score long")
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score"))
