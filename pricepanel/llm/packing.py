"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

A document longer than a bin is cut into pieces of full bins and a rest.  Pieces are dealt by a hash into
groups of about ``group_size`` words, and each group is packed by itself, largest piece first: from the
tightest bin that can hold the piece, the search goes on to the next larger residual until a bin is
compatible; if none is, a new bin is opened.  A bin carries a bitmap of its sources, ``source_limit`` bits
each, and one of its duplicate clusters: a piece conflicts with a bin that has its source's bits all set,
or its cluster's bit.  Counts by residual of the bins that are closed to a source let the search pass
over residuals without a compatible bin.

Groups are cut by words (a piece counts ``MIN_WEIGHT`` at least), so neither a hot source nor a large
cluster makes a task larger; it only opens more bins.  Only ids, sizes and hashes are shuffled.

Defined cases: NULL and empty texts have one piece of size 0, placed like any other; NULL source is a
source; repeated rows are documents of their own in one cluster; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ROW, shuffle_partitions, word_count
from .simhash import near_duplicates
from .vectors import groups

MIN_WEIGHT = 32


def best_fit(sizes: list, sources: list, clusters: list, capacity: int, source_limit: int) -> list[tuple[int, int, int]]:
    """(bin, slot, offset) of each piece; pieces come in the order they are placed."""
    shared = {c: i for i, (c, n) in enumerate(Counter(clusters).items()) if n > 1}
    numbers: dict = {}
    full = (1 << source_limit) - 1
    bins_at: dict[int, list[int]] = {}                       # residual -> bins
    n_at = np.zeros(capacity + 1, np.int32)
    shut: dict[int, np.ndarray] = {}                         # source -> bins closed to it, by residual
    holds: dict[int, dict[int, int]] = {}                    # cluster -> bins holding it, by residual
    residual, source_bits, cluster_bits, filled = [], [], [], []
    members: list[list[int]] = []                            # clusters (shared ones) of each bin
    closed: list[list[int]] = []                             # sources each bin is closed to
    out = []

    def move(b: int, old: int | None, new: int) -> None:
        if old is not None:
            bins_at[old].remove(b)
            n_at[old] -= 1
            for s in closed[b]:
                shut[s][old] -= 1
            for c in members[b]:
                holds[c][old] -= 1
        bins_at.setdefault(new, []).append(b)
        n_at[new] += 1
        for s in closed[b]:
            shut[s][new] += 1
        for c in members[b]:
            holds[c][new] = holds[c].get(new, 0) + 1

    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = numbers.setdefault(source, len(numbers)), shared.get(cluster)
        closed_to = shut.get(s)
        if closed_to is None:
            closed_to = shut[s] = np.zeros(capacity + 1, np.int32)
        held = holds.setdefault(c, {}) if c is not None else {}
        place, shift, bit = None, s * source_limit, 0 if c is None else 1 << c
        for r in (np.flatnonzero(n_at[size:] > closed_to[size:]) + size).tolist() if size < capacity else ():
            if held.get(r, 0) == n_at[r]:
                continue
            place = next((b for b in bins_at[r] if source_bits[b] >> shift & full != full
                          and not cluster_bits[b] & bit), None)
            if place is not None:
                break
        if place is None:
            place, old = len(residual), None
            residual.append(capacity)
            source_bits.append(0)
            cluster_bits.append(0)
            filled.append(0)
            members.append([])
            closed.append([])
        else:
            old = residual[place]
        out.append((place, filled[place], capacity - residual[place]))
        if old is not None:  # leaves its place with its old marks
            move(place, old, old - size)
        residual[place] -= size
        filled[place] += 1
        bits = source_bits[place] >> shift & full
        source_bits[place] |= (bits + 1) << shift            # the next of the source's bits, from the lowest
        if old is None:
            move(place, None, residual[place])
        if (source_bits[place] >> shift & full) == full:
            closed[place].append(s)
            closed_to[residual[place]] += 1
        if c is not None:
            cluster_bits[place] |= bit
            members[place].append(c)
            held[residual[place]] = held.get(residual[place], 0) + 1
    return out


def _pack_groups(capacity: int, source_limit: int):
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("size", pa.int64()), ("bin", pa.int64()),
                        ("slot", pa.int32()), ("offset", pa.int64())])

    def run(batches):
        for g in groups(batches, ["group"]):
            size = g["size"].to_pylist()
            where = best_fit(size, g["source"].to_pylist(), g["cluster"].to_pylist(), capacity, source_limit)
            bins, slots, offsets = (np.array(x, np.int64) for x in zip(*where))
            yield pa.record_batch([
                g["id"].combine_chunks(), g["piece"].combine_chunks(), pa.array(size, pa.int64()),
                pa.array(bins + (g["group"][0].as_py() << 32)), pa.array(slots.astype(np.int32)), pa.array(offsets)],
                schema=schema)
    return run


def pack(docs: DataFrame, capacity: int = 2048, source_limit: int = 4, group_size: int = 1_000_000,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size=None, cluster=None) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``size``, ``bin``, ``slot`` (in the bin, from 0), ``offset``.

    ``size`` (LONG column, default: words of the text) and ``cluster`` (LONG column, default: a hash of the
    text, so equal texts) may be given.
    """
    size = word_count(text_col) if size is None else size
    cluster = F.xxhash64(text_col) if cluster is None else cluster
    rows = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("id"), size.alias("size"), F.xxhash64(source_col).alias("source"),
        cluster.alias("cluster"), F.monotonically_increasing_id().alias("row")), "pack-sizes")
    weight = rows.agg(F.sum(F.greatest("size", F.lit(MIN_WEIGHT)))).first()[0] or 0
    n_groups = max(1, -(-weight // group_size))
    last = F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / capacity).cast("int")
    pieces = rows.withColumn("last", last).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("last")))).select(
        "id", "piece", "source", "cluster", "row",
        F.least(F.lit(capacity), F.col("size") - F.col("piece").cast("long") * capacity).cast("long").alias("size"),
        F.pmod(F.xxhash64("row", "piece"), F.lit(n_groups)).alias("group"))
    packed = (pieces.repartition(shuffle_partitions(docs.sparkSession), "group")
              .sortWithinPartitions("group", F.col("size").desc(), "id", "piece", "row")
              .mapInArrow(_pack_groups(capacity, source_limit),
                          "id long, piece int, size long, bin long, slot int, offset long"))
    return packed.withColumnRenamed("id", id_col)


def pack_apart(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", **options) -> DataFrame:
    """``pack`` with the near-duplicate groups of the SimHash operator as clusters: near copies never share a bin.

    A document finds its group by two hashes of its text; no text is written or shuffled.
    """
    hashes = [F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit(17), text_col).alias("h2")]
    found = near_duplicates(docs.select(hashes[0].alias("doc_id"), hashes[1].alias(ROW), F.col(text_col).alias("text")), shingle, max_bits)
    roots = found.select(F.col("doc_id").alias("h1"), F.col("row_key").alias("h2"), "root").distinct()
    sized = docs.select(F.col(id_col), F.col(source_col), word_count(text_col).alias("__llm_size"), *hashes).join(roots, ["h1", "h2"])
    return pack(sized, id_col=id_col, source_col=source_col, size=F.col("__llm_size"), cluster=F.col("root"), **options)
