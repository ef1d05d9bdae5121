"""Competitor price operators: outlier filter, dedupe, pivot, merge, sparsity.

Scale notes
-----------
* ``rolling_median`` counts values per (key, day) first, and never partitions
  by the (product, competitor) key alone: a key holding a third of all rows
  would land in one task.  The counts are split into time buckets of
  ``window_days``; each is copied into its own and the next bucket, so every
  bucket sees the full look-back of its days.  A task holds one bucket of one
  key at a time: at most two windows' days with their distinct prices.
* ``first_n_median`` keeps at most N rows of a key in a map task before the
  shuffle, or (without an order inside a day) the days that hold them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.scalars import iso_year_week, round_half_up, slug_price_name
from ..session import cut_lineage


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def _time_buckets(df: DataFrame, date_col: str, window_days: int) -> DataFrame:
    """Copy each row into its own time bucket and the next one (bucket width = window)."""
    return (df.withColumn("_dn", F.unix_date(F.col(date_col)))
            .withColumn("_bucket", F.floor(F.col("_dn") / F.lit(int(window_days))))
            .withColumn("_wb", F.explode(F.array(F.col("_bucket"), F.col("_bucket") + 1))))


def rolling_median(df: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                   window_days: int = 180, median_col: str = "rolling_median",
                   count_col: str = "rolling_count", method: str = "stream") -> DataFrame:
    """Median and non-NULL count of ``value_col`` over the day range (t-window, t] per key.

    RANGE semantics: same-day peers are inside the frame.  ``method="window"`` uses a
    SQL window (``percentile`` re-evaluated per distinct day: O(rows x frame));
    ``method="stream"`` first counts values per (key, day), so a task sees distinct values and not
    rows, and takes the medians of many (key, time bucket) in one numpy pass (O(values x log values)).
    Rows without a date take no part.
    """
    keys = _cols(keys)
    wd = int(window_days)
    dated = df.filter(F.col(date_col).isNotNull())
    if method == "window":
        w = Window.partitionBy(*keys, "_wb").orderBy("_dn").rangeBetween(-(wd - 1), 0)
        return (_time_buckets(dated, date_col, wd)
                .withColumn(median_col, F.percentile(F.col(value_col), F.lit(0.5)).over(w))
                .withColumn(count_col, F.count(F.col(value_col)).over(w))
                .filter(F.col("_wb") == F.col("_bucket"))
                .drop("_dn", "_bucket", "_wb"))
    stats = rolling_median_days(dated, keys, date_col, value_col, wd, median_col, count_col)
    return _join_days(dated, stats, keys, date_col)


def rolling_median_days(df: DataFrame, keys: Sequence[str], date_col: str, value_col: str, window_days: int,
                        median_col: str, count_col: str) -> DataFrame:
    """One row (keys, ``_day``, median, count) per key and day that occurs."""
    counts = df.groupBy(*keys, date_col, F.col(value_col).cast("double").alias("_v")).agg(F.count(value_col).alias("_n"))
    staged = _time_buckets(counts, date_col, window_days).select(*keys, "_wb", "_bucket", "_dn", "_v", "_n")
    # an explicit partition count: CPU-heavy tasks are not coalesced by their few bytes
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    out = StructType([*[f for f in df.schema.fields if f.name in keys], StructField("_dn", LongType()),
                      StructField(median_col, DoubleType()), StructField(count_col, LongType())])
    out = StructType(sorted(out.fields[:-3], key=lambda f: keys.index(f.name)) + out.fields[-3:])
    return (staged.repartition(parts, *keys, "_wb").sortWithinPartitions(*keys, "_wb", "_dn", "_v")
            .mapInArrow(_rolling_days(window_days, list(keys), out.names), out)
            .withColumn("_day", F.date_from_unix_date(F.col("_dn").cast("int"))).drop("_dn"))


def _join_days(df: DataFrame, stats: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    on = [df[k].eqNullSafe(stats[k]) for k in keys] + [df[date_col] == stats["_day"]]
    rest = [c for c in stats.columns if c not in (*keys, "_day")]
    return df.join(stats, on).select(*[df[c] for c in df.columns], *[stats[c] for c in rest])


#: Value counts taken into one numpy pass; a bucket of a key that has more is taken whole.
PASS_ROWS = 400_000


def _kth_in_ranges(codes, weights, first, last, ranks):
    """For each range [first, last) of the sequence: the code at a rank (from 0) of its weighted order.

    A wavelet matrix: the sequence is split stably by one bit of the codes after another, high to low.  With the
    prefix sums of the weights that have a zero bit, every range knows how much of it goes left; all ranges and
    ranks take the step together.
    """
    import numpy as np
    lo, hi, left = first.copy(), last.copy(), ranks.copy()
    out = np.zeros(len(ranks), np.int64)
    for bit in range(max(1, int(codes.max(initial=0)).bit_length()) - 1, -1, -1):
        zero = (codes >> bit) & 1 == 0
        places = np.concatenate([[0], np.cumsum(zero)])               # zero bits before each position
        weight = np.concatenate([[0], np.cumsum(np.where(zero, weights, 0))])
        smaller = weight[hi] - weight[lo]
        up = left >= smaller
        left = np.where(up, left - smaller, left)
        out = (out << 1) | up
        lo, hi = (np.where(up, places[-1] + x - places[x], places[x]) for x in (lo, hi))
        order = np.concatenate([np.flatnonzero(zero), np.flatnonzero(~zero)])
        codes, weights = codes[order], weights[order]
    return out


def _window_medians(group, day, value, weight, own, window_days: int):
    """(position of a row of the day, median or NaN, total weight) of each group's own days; rows sorted by (group, day)."""
    import numpy as np
    start = int(day.min()) - window_days
    span = int(day.max()) - start + 1
    line = group * span + (day - start)  # group and day on one axis, a window between two groups
    levels, codes = np.unique(value, return_inverse=True)
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    at = np.flatnonzero(new & own)
    last = np.searchsorted(line, line[at], side="right")
    first = np.searchsorted(line, line[at] - window_days, side="right")
    before = np.concatenate([[0], np.cumsum(weight)])
    total = before[last] - before[first]
    some = np.flatnonzero(total > 0)
    ranks = np.concatenate([(total[some] - 1) // 2, total[some] // 2])
    middle = levels[_kth_in_ranges(codes, weight, np.tile(first[some], 2), np.tile(last[some], 2), ranks)]
    median = np.full(len(at), np.nan)
    median[some] = (middle[:len(some)] + middle[len(some):]) / 2
    return at, median, total


def _rolling_days(window_days: int, keys: list[str], names: list[str]):
    """Value counts sorted by (keys, bucket, day) to medians a day: many buckets in one pass, each in one pass only."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held, rows = [], 0

        def starts(t):
            """Whether a row begins another bucket or key; NULL keys are equal to each other."""
            new = np.ones(t.num_rows, bool)
            codes = [t["_wb"].to_numpy()]
            for k in keys:
                d = t[k].combine_chunks().dictionary_encode()
                codes.append((d.chunk(0) if isinstance(d, pa.ChunkedArray) else d).indices.fill_null(-1).to_numpy(zero_copy_only=False))
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in codes])
            return new

        def medians(t, new):
            value = t["_v"].to_numpy(zero_copy_only=False)
            at, median, total = _window_medians(
                np.cumsum(new), t["_dn"].to_numpy(), np.where(np.isnan(value), 0.0, value), t["_n"].to_numpy(),
                t["_wb"].to_numpy() == t["_bucket"].to_numpy(), window_days)
            cols = [t[k].combine_chunks().take(pa.array(at)) for k in keys]
            return pa.record_batch([*cols, pa.array(t["_dn"].to_numpy()[at].astype(np.int64)),
                                    pa.array(median, mask=total == 0), pa.array(total)], names=names)

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < PASS_ROWS:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            new = starts(t)
            cut = int(np.flatnonzero(new)[-1])  # the last bucket may go on
            if cut:
                yield medians(t.slice(0, cut), new[:cut])
            held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if rows:
            t = pa.Table.from_batches(held).combine_chunks()
            yield medians(t, starts(t))

    return run


def first_n_median(df: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                   n: int = 5, tiebreak: Sequence[str] = (), out_col: str = "baseline_median") -> DataFrame:
    """Median of the first ``n`` non-NULL observations per key (one row per key).

    ``tiebreak`` orders the observations of a day; without it the order within a day is unknown, and all
    observations of the days that hold the first ``n`` are used.
    """
    keys = _cols(keys)
    obs = df.filter(F.col(value_col).isNotNull() & F.col(date_col).isNotNull())
    if tiebreak:
        # planned as a WindowGroupLimit that also runs before the shuffle: a key moves at most n rows a map task
        first = Window.partitionBy(*keys).orderBy(date_col, *tiebreak)
        return (obs.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= n)
                .groupBy(*keys).agg(F.median(value_col).alias(out_col)))
    per_day = obs.groupBy(*keys, date_col).agg(F.count(F.lit(1)).alias("_n"))
    wd = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    early_days = (per_day.withColumn("_before", F.coalesce(F.sum("_n").over(wd), F.lit(0)))
                  .filter(F.col("_before") < n).select(*keys, date_col))
    return obs.join(early_days, [*keys, date_col], "left_semi").groupBy(*keys).agg(F.median(value_col).alias(out_col))


def flag_price_outliers(df: DataFrame, keys: Sequence[str] = ("product_code", "competitor_name"),
                        date_col: str = "price_date", price_col: str = "normalized_price",
                        window_days: int = 180, high: float = 2.0, low: float | None = 0.3,
                        min_observations: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Adds ``baseline``, ``is_high_outlier``, ``is_low_outlier``, ``is_outlier``; rows without a price or
    a date are dropped.

    The priced rows are written once and shuffled once: the baseline of a day (its rolling median, or the first
    observations' where the window holds fewer than ``min_observations``) is settled per key and day before.
    """
    keys = _cols(keys)
    priced = cut_lineage(df.filter(F.col(price_col).isNotNull() & F.col(date_col).isNotNull()), "priced")
    stats = rolling_median_days(priced, keys, date_col, price_col, int(window_days), "_median", "_count")
    base = first_n_median(priced, keys, date_col, price_col, min_observations, tiebreak, "_first")
    days = stats.join(base, [stats[k].eqNullSafe(base[k]) for k in keys], "left").select(
        *[stats[k] for k in keys], "_day",
        F.when(F.col("_count") >= min_observations, F.col("_median")).otherwise(F.col("_first")).alias("baseline"))
    out = _join_days(priced, days, keys, date_col)
    out = out.withColumn("is_high_outlier", F.col(price_col) > F.lit(high) * F.col("baseline"))
    if low is None:
        out = out.withColumn("is_low_outlier", F.lit(False))
    else:
        out = out.withColumn("is_low_outlier", F.col(price_col) < F.lit(low) * F.col("baseline"))
    return out.withColumn("is_outlier", F.col("is_high_outlier") | F.col("is_low_outlier"))


def filter_price_outliers(df: DataFrame, **kw) -> DataFrame:
    """Drop rows whose price is above ``high`` x or below ``low`` x the rolling baseline."""
    cols = df.columns
    flagged = flag_price_outliers(df, **kw)
    return flagged.filter(~F.col("is_outlier")).select(*cols)


def outlier_report(flagged: DataFrame) -> DataFrame:
    """High / low / total outlier counts and percentage (one row)."""
    return flagged.agg(
        F.count_if(F.col("is_high_outlier")).alias("high_outliers"),
        F.count_if(F.col("is_low_outlier")).alias("low_outliers"),
        F.count_if(F.col("is_outlier")).alias("total_outliers"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("outlier_pct", round_half_up(F.try_divide(F.col("total_outliers") * 100.0, F.col("rows")), 6))


def write_with_report(flagged: DataFrame, path: str) -> DataFrame:
    """Write the rows that are no outliers, and return the outlier report (one row) of the same run.

    The counts are observed where the rows pass on their way to the files, so nothing runs twice.  They are taken in
    the writing stage itself, whose tasks count once each: a task that an executor loses is not counted, the one that
    replaces it is.
    """
    seen = Observation("outliers")
    out = flagged.observe(seen, F.count_if("is_high_outlier").alias("high_outliers"), F.count_if("is_low_outlier").alias("low_outliers"),
                          F.count_if("is_outlier").alias("total_outliers"), F.count(F.lit(1)).alias("rows"))
    (out.filter(~F.col("is_outlier")).drop("baseline", "is_high_outlier", "is_low_outlier", "is_outlier")
     .write.mode("overwrite").parquet(path))
    got = seen.get
    names = ("high_outliers", "low_outliers", "total_outliers", "rows")
    report = flagged.sparkSession.createDataFrame([tuple(got[n] for n in names)], ", ".join(f"{n} long" for n in names))
    return report.withColumn("outlier_pct", round_half_up(F.try_divide(F.col("total_outliers") * 100.0, F.col("rows")), 6))


def median_dedupe(df: DataFrame, keys: Sequence[str] = ("product_code", "price_date", "competitor_name"),
                  price_col: str = "normalized_price") -> DataFrame:
    """One price per (product, day, competitor): the median of the duplicates."""
    return df.groupBy(*keys).agg(F.median(price_col).alias(price_col))  # a key's prices of one day


def competitor_names(df: DataFrame, name_col: str = "competitor_name") -> list[str]:
    """Plan-time list of competitor names (bounded: one per competitor)."""
    return sorted(r[0] for r in df.select(name_col).where(F.col(name_col).isNotNull()).distinct().collect())


def pivot_competitors(df: DataFrame, competitors: Sequence[str] | None = None,
                      keys: Sequence[str] = ("product_code", "price_date"),
                      name_col: str = "competitor_name", price_col: str = "normalized_price") -> DataFrame:
    """Long -> wide: one ``<slug>_price`` column per competitor.

    Pass ``competitors`` explicitly to avoid the extra distinct job.
    """
    names = list(competitors) if competitors is not None else competitor_names(df, name_col)
    wide = df.groupBy(*keys).pivot(name_col, names).agg(F.first(price_col, ignorenulls=True))
    return wide.select(*keys, *[F.col(f"`{n}`").alias(slug_price_name(n)) for n in names])


def merge_sales_competitors(sales: DataFrame, wide: DataFrame, date_col: str = "date",
                            wide_date_col: str = "price_date", key: str = "product_code") -> DataFrame:
    """sales LEFT JOIN competitor-wide on (product, day); adds ``year_week``.

    With sales and competitor prices bucketed by (product, day) (``sources.io.write_bucketed``) the de-duplication, the
    pivot and this join plan no exchange.
    """
    right = wide.withColumnRenamed(wide_date_col, "_join_date")
    joined = sales.join(right, (sales[key] == right[key]) & (sales[date_col] == right["_join_date"]), "left")
    return joined.drop(right[key]).drop("_join_date").withColumn("year_week", iso_year_week(date_col))


def null_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of NULLs per column (one row)."""
    return df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"{c}_null_pct") for c in cols])


def apply_content_factor(df: DataFrame, competitors: Sequence[str]) -> DataFrame:
    """``{c}_price *= {c}_content_factor`` where both columns exist."""
    out = df
    for c in competitors:
        p, f = f"{c}_price", f"{c}_content_factor"
        if p in df.columns and f in df.columns:
            out = out.withColumn(p, F.col(p) * F.col(f))
    return out


def drop_sparse_competitors(df: DataFrame, competitors: Sequence[str], max_null_pct: float = 59.0) -> DataFrame:
    """Drop competitor price columns whose NULL share exceeds ``max_null_pct``.

    One aggregate action decides the column set at plan time (a schema decision); the rows are written once before,
    so what made them does not run again for the result.
    """
    present = [f"{c}_price" for c in competitors if f"{c}_price" in df.columns]
    if not present:
        return df
    df = cut_lineage(df, "competitor-shares")
    shares = null_share(df, present).first().asDict()
    drop = [c for c in present if (shares[f"{c}_null_pct"] or 0.0) > max_null_pct]
    return df.drop(*drop)
