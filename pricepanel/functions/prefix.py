"""Global prefix sums and exact medians without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def prefix_sums(df: DataFrame, order: list, measures: dict[str, str], name: str) -> tuple[DataFrame, DataFrame]:
    """Exclusive global prefix sums along a total order, without a single-task window.

    Rows are range-partitioned by ``order`` and written once (so partition numbers are fixed);
    per-partition totals (one row per partition) give each partition its offset, a window inside
    the partition the rest.  ``order`` must be total, or equal rows may swap between reruns.
    ``measures`` maps each LONG input column to the name of its prefix column.  Returns the rows
    with the prefix columns, and the one-row totals (``total_<input>``).
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), name)
    totals = ranged.groupBy("_pid").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}")
                                      for m in measures])
    within = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.join(F.broadcast(offsets), "_pid")  # bounded: one row per shuffle partition
    rows = rows.select(*[c for c in ranged.columns if c != "_pid"],
                       *[(F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(within), F.lit(0))).alias(p)
                         for m, p in measures.items()])
    return rows, totals.agg(*[F.coalesce(F.sum(f"_t_{m}"), F.lit(0)).alias(f"total_{m}") for m in measures])


def exact_medians(df: DataFrame, value_col: str, groups: Sequence[str] = (), out_col: str = "median") -> DataFrame:
    """Exact median per group (one row without ``groups``), however many rows a group has.

    Values are counted per (group, value) before the shuffle, the counts get running totals over the
    whole order, and the one or two values that cover the middle ranks are averaged.  No task ever holds
    a whole group.  NULL values are left out; a group without values has no row (without ``groups``: NULL).
    """
    keys = list(groups)
    counts = df.filter(F.col(value_col).isNotNull()).groupBy(*keys, F.col(value_col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    ranked, _ = prefix_sums(counts, [*keys, "_v"], {"_n": "_before"}, "median-ranks")
    ends = ranked.groupBy(*keys).agg(F.min("_before").alias("_start"), F.sum("_n").alias("_total"))
    if keys:
        ends = ends.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        joined = ranked.join(ends, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    else:
        joined = ranked.join(F.broadcast(ends))  # one row of totals
    rank = F.col("_before") - F.col("_start")
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    middle = joined.filter((rank <= high) & (rank + F.col("_n") > low))
    return middle.groupBy(*keys).agg((F.lit(0.5) * F.min("_v") + F.lit(0.5) * F.max("_v")).alias(out_col))
