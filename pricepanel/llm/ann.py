"""Approximate nearest neighbours by collision counting.

Vectors are dealt into blocks of about ``block`` rows.  Each block is projected on ``projections``
directions (orthonormal bases, drawn from a seed), one sorted array per direction.  A query looks at a
window around its own projection in every array; a vector that lies in enough windows at once is
verified by its exact cosine.  Virtual rehashing widens the windows in proportion to a radius until the
k-th best verified vector lies within the radius, for which the windows are meant: windows are
``WIDTH`` standard deviations of a difference of that length, and the threshold leaves a margin below
the collisions expected at it.  Beyond the largest possible distance every vector left is verified.

Every block is searched for every query (queries are copied to the blocks, never gathered), and the best
k of all blocks are kept.  Recall against brute force is measured in the tests.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components take no part;
only vectors of the query's dimension are compared; NULL ids take no part; repeated rows are candidates
each; a query row that is repeated is answered as often; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import join_small, shuffle_partitions
from .vectors import matrix, slices, unit, usable

WIDTH, MARGIN, FIRST_RADIUS, GROWTH = 1.5, 1.0, 0.5, 1.15


@lru_cache(8)
def directions(dim: int, projections: int, seed: int) -> np.ndarray:
    """Columns of random orthonormal bases."""
    r = np.random.default_rng([seed, dim])
    bases = [np.linalg.qr(r.standard_normal((dim, dim)))[0] for _ in range(-(-projections // dim))]
    return np.concatenate(bases, axis=1)[:, :projections]


class Block:
    """Sorted projection arrays of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, seed: int):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.axes = directions(vectors.shape[1], projections, seed)
        p = (unit(vectors) @ self.axes).T
        self.order = np.argsort(p, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(p, self.order, axis=1)
        chance = erf(WIDTH / sqrt(2))
        m = self.axes.shape[1]
        self.threshold = m * chance - MARGIN * sqrt(m * chance * (1 - chance))

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int):
        """(query number, ids, cosines) of the best k verified vectors of each query, its own id left out."""
        n, m, scale = len(self.ids), len(self.values), WIDTH / sqrt(queries.shape[1])
        at, q_norms = unit(queries) @ self.axes, np.sqrt((queries * queries).sum(axis=1))
        radii = [FIRST_RADIUS]
        while radii[-1] < 2:
            radii.append(radii[-1] * GROWTH)
        reach = scale * np.array(radii)
        low = np.stack([np.searchsorted(v, at[:, j, None] - reach, "left") for j, v in enumerate(self.values)], axis=2)
        high = np.stack([np.searchsorted(v, at[:, j, None] + reach, "right") for j, v in enumerate(self.values)], axis=2)
        for q in range(len(queries)):
            other = self.ids != query_ids[q]
            hits, verified = np.zeros(n, np.int64), ~other
            found, scores = np.empty(0, np.int64), np.empty(0)
            lows, highs = low[q].tolist(), high[q].tolist()
            left, right = lows[0], lows[0]
            for r, radius in enumerate(radii):  # virtual rehashing: the windows' new ends only
                ends = [self.order[j, lows[r][j]:left[j]] for j in range(m)] if r else []
                ends += [self.order[j, right[j]:highs[r][j]] for j in range(m)]
                left, right = lows[r], highs[r]
                hits += np.bincount(np.concatenate(ends), minlength=n)
                new = np.flatnonzero((hits >= self.threshold) & ~verified)
                found, scores = self._verify(new, queries[q], q_norms[q], found, scores)
                verified[new] = True
                if len(found) >= k and np.partition(scores, -k)[-k] >= 1 - radius * radius / 2:
                    break
            else:
                found, scores = self._verify(np.flatnonzero(~verified), queries[q], q_norms[q], found, scores)
            best = np.lexsort((self.ids[found], -scores))[:k]
            yield q, self.ids[found[best]], scores[best]

    def _verify(self, new, query, q_norm, found, scores):
        # a plain row sum: equal vectors get equal scores, wherever they stand
        cosine = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * q_norm)
        return np.append(found, new), np.append(scores, cosine)


_OUT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_blocks(k: int, projections: int, seed: int):
    """Rows sorted by (dim, block, query): a block's vectors come first, its queries stream after them."""
    def run(batches):
        key, held, block = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            dims, blocks, kind = (t[c].to_numpy() for c in ("dim", "block", "query"))
            for s, e in slices([dims, blocks, kind]):
                part, here = t.slice(s, e - s).combine_chunks(), (int(dims[s]), int(blocks[s]))
                if here != key:
                    key, held, block = here, [], None
                ids, vectors = part["vec_id"].to_numpy(), matrix(part["vector"].combine_chunks())
                if not kind[s]:
                    held.append((ids, vectors))
                    continue
                if block is None and held:
                    block = Block(*(np.concatenate(x) for x in zip(*held)), projections, seed)
                    held = []
                if block is None:
                    continue
                out, rows = [[], [], []], part["row"].to_numpy()
                for q0 in range(0, len(ids), 256):
                    for q, near, scores in block.search(vectors[q0:q0 + 256], ids[q0:q0 + 256], k):
                        out[0].append(np.full(len(near), q0 + q))
                        out[1].append(near)
                        out[2].append(scores)
                q, near, scores = (np.concatenate(x) for x in out)
                yield pa.record_batch([pa.array(rows[q]), pa.array(ids[q]), pa.array(near), pa.array(scores)], schema=_OUT)
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            block: int = 8192, projections: int = 64, seed: int = 11) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (cosine): the k nearest found of each query row.

    ``is_query`` picks the queries among the rows; candidates are all rows but those of the query's id.
    Ties go to the smaller id.
    """
    rows = cut_lineage(vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"),
        F.size(vector_col).cast("long").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"))
        .filter(F.col("vec_id").isNotNull() & usable("vector")), "ann-vectors")
    dims = cut_lineage(rows.groupBy("dim").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")), "ann-blocks")
    rows = join_small(rows, dims, "dim")
    dealt = rows.select("dim", F.pmod(F.xxhash64("row"), "blocks").alias("block"), F.lit(0).alias("query"), "row",
                        "vec_id", "vector")
    asked = rows.filter("asks").select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                                       F.lit(1).alias("query"), "row", "vec_id", "vector")
    found = (dealt.unionAll(asked).repartition(shuffle_partitions(vectors.sparkSession), "dim", "block")
             .sortWithinPartitions("dim", "block", "query", "row")
             .mapInArrow(_search_blocks(k, projections, seed), "query_row long, query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
