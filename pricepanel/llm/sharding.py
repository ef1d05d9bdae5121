"""Contiguous balanced shards by global byte-size prefix sums (DataFrame operations only).

Order is the document id (NULL ids first), ties by checksum, size and row; only id, size and
checksum are shuffled, never the text.  Each row goes to the shard in whose equal share of the
total bytes its middle byte falls, so a shard misses its target by at most one row at either end.

Defined cases: NULL or empty text has size ``overhead`` and checksum 0; repeated rows are kept, each
with a slot of its own; an empty table gives an empty result; other columns of the input are
ignored, whatever their names; a row larger than a shard's target leaves neighbours empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import prefix_sums
from ..session import cut_lineage


def assign_shards(docs: DataFrame, n_shards: int = 40, overhead: int = 16, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(overhead)).cast("long").alias("_size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("_crc"),
        F.lit(1).cast("long").alias("_one"),
        F.monotonically_increasing_id().alias("_row")), "shard-sizes")
    placed, totals = prefix_sums(rows, ["_id", "_crc", "_size", "_row"], {"_size": "_before", "_one": "_index"},
                                 "shard-ranges")
    middle = (F.lit(2) * F.col("_before") + F.col("_size")) * F.lit(n_shards)
    placed = placed.withColumn("_shard", F.least(
        F.lit(n_shards - 1), F.call_function("div", middle, F.lit(2) * totals.select("total__size").scalar())
        .cast("int")))
    starts = placed.groupBy("_shard").agg(F.min("_index").alias("_first"))
    return placed.join(F.broadcast(starts), "_shard").select(  # bounded: one row per shard
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        (F.col("_index") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write whole documents as one folder per shard, ordered by slot (ids must be unique)."""
    (docs.join(shards.select(id_col, "shard", "slot"), id_col)
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
