"""A date-keyed series stored as one row a date, in partitions by month that an update replaces whole.

An update (a re-fetch, a backfill) reads the months it touches, lets the fresh row win on its date, and overwrites
just these months (dynamic partition overwrite: tasks write aside, the commit moves whole partitions into place).
Readers read the table as it is, without an aggregate over its history.  Running an update again gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.io import exists

MONTH_COL = "_month"


def _month(date_col: str):
    return F.date_format(date_col, "yyyy_MM")


def _latest(df: DataFrame, date_col: str, order: list[str]) -> DataFrame:
    """One row a date: the largest by ``order``, then by its values."""
    cols = [c for c in df.columns if c not in (date_col, *order)]
    kept = [c for c in df.columns if c not in (date_col, "_fresh")]
    picked = df.groupBy(date_col).agg(F.max_by(F.struct(*kept), F.struct(*order, *cols)).alias("_r"))
    return picked.select(date_col, *[F.col(f"_r.{c}").alias(c) for c in kept])


def upsert_by_month(spark: SparkSession, path: str, fresh: DataFrame, date_col: str = "date") -> list[str]:
    """Merge ``fresh`` into the table at ``path`` (created if missing); the months rewritten, in order.

    Of several fresh rows of a date the largest by value wins.  Rows without a date take no part.  The merged months
    are written aside first, so the table is never read and overwritten by one job; a failed run leaves it as it was.
    """
    fresh = cut_lineage(fresh.filter(F.col(date_col).isNotNull()), "fresh")
    months = sorted(r[0] for r in fresh.select(_month(date_col)).distinct().collect())  # one row per month touched
    if not months:
        return []
    rows = fresh.withColumn("_fresh", F.lit(1))
    if exists(spark, path):
        stored = read_series(spark, path, months).select(*fresh.columns).withColumn("_fresh", F.lit(0))
        rows = rows.unionByName(stored)
    merged = cut_lineage(_latest(rows, date_col, ["_fresh"]), "merged")
    (merged.withColumn(MONTH_COL, _month(date_col)).hint("rebalance", MONTH_COL)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COL).parquet(path))
    return months


def read_series(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The stored rows, one a date; ``months`` (yyyy_MM) prunes partitions."""
    df = spark.read.option("basePath", path).parquet(path)
    if months is not None:
        df = df.filter(F.col(MONTH_COL).cast("string").isin(list(months)))
    return df.drop(MONTH_COL)
