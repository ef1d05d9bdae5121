"""Weekly panels: ISO-week aggregate, Monday-binned resample with gap weeks, tail-N rows.

The gap fill enumerates weeks per product with ``sequence`` between that
product's first and last week: output rows grow with products x weeks (bounded
by the calendar), never with the number of sales rows per product.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import fixed_point_sum, iso_year_week, round_half_up, week_start
from .features import ffill_columns


def last_value(value_col: str, order_col: str):
    """Aggregate: the latest value that is not NULL (of equal dates the largest value)."""
    v = F.col(value_col)
    return F.max(F.when(v.isNotNull(), F.struct(F.col(order_col), v.alias("_v"))))["_v"]


def weekly_iso(df: DataFrame, target_col: str = "quantity_sold", price_col: str = "product_selling_price",
               competitor_cols: Sequence[str] = (), product_col: str = "product_code",
               date_col: str = "date", carry_last: Sequence[str] = (), sum_cols: Sequence[str] = ()) -> DataFrame:
    """Aggregate to (product, ISO year_week): target sum, price mean, first date, competitor means.

    ``carry_last`` / ``sum_cols`` keep category and revenue columns the reference dropped; a carried value
    is the last one that is not NULL, a sum over NULLs alone is 0.
    """
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0).cast(df.schema[c].dataType)).alias(c)
    aggs = [zero(target_col), F.avg(price_col).alias(price_col), F.min(date_col).alias(date_col)]
    aggs += [F.avg(c).alias(c) for c in competitor_cols if c in df.columns]
    aggs += [last_value(c, date_col).alias(c) for c in carry_last]
    aggs += [zero(c) for c in sum_cols]
    return df.withColumn("year_week", iso_year_week(date_col)).groupBy(product_col, "year_week").agg(*aggs)


def weekly_resample(df: DataFrame, last_cols: Sequence[str] = ("product_selling_price",),
                    sum_cols: Sequence[str] = ("quantity_sold",), product_col: str = "product_code",
                    date_col: str = "date", fill: bool = True) -> DataFrame:
    """Monday-labelled weeks [Mon, next Mon) with empty weeks inserted.

    last -> the last value of the week that is not NULL; sum -> 0 in an empty week or one of NULLs;
    with ``fill`` the ``last`` columns are forward filled per product afterwards.
    Each weekly row expands into itself plus the empty weeks up to the product's next sale week
    (``lead`` + ``posexplode``): no week grid, no join, and the fill window reuses the same
    product partitioning.
    """
    wk = week_start(date_col)
    aggs = [last_value(c, date_col).alias(c) for c in last_cols] + [F.sum(c).alias(c) for c in sum_cols]
    weekly = df.groupBy(product_col, wk.alias("week")).agg(*aggs)
    w = Window.partitionBy(product_col).orderBy("week")
    staged = weekly.withColumn("_last_week", F.coalesce(F.date_sub(F.lead("week").over(w), 7), F.col("week")))
    spread = staged.select(product_col, *last_cols, *sum_cols,
                           F.posexplode(F.sequence(F.col("week"), F.col("_last_week"), F.expr("INTERVAL 7 DAYS")))
                           .alias("_gap", "week"))
    own = F.col("_gap") == 0
    out = spread.select(
        product_col, "week",
        *[F.when(own, F.col(c)).alias(c) for c in last_cols],
        *[F.coalesce(F.when(own, F.col(c)), F.lit(0).cast(df.schema[c].dataType)).alias(c) for c in sum_cols])
    if fill:
        out = ffill_columns(out, list(last_cols), product_col, "week")
    return out


def last_n_rows(df: DataFrame, n: int, product_col: str = "product_code", date_col: str = "date",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows per product by date (tail per group)."""
    w = Window.partitionBy(product_col).orderBy(*[F.col(c).desc() for c in [date_col, *tiebreak]])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def weekly_weather(weather: DataFrame, rounding: Mapping[str, int] | None = None, date_col: str = "date",
                   scale: int | None = None) -> DataFrame:
    """Weekly mean of daily weather with per-column rounding.

    ``scale`` states that the values are fixed-point with so many decimals (station values: 1); the mean
    is then an exact sum over the count, and the rounding does not depend on the summation order.
    """
    rounding = rounding or {"mean_temp": 1, "min_temp": 1, "max_temp": 1, "sum_rain": 0, "len_rain": 0}
    mean = (lambda c: F.avg(c)) if scale is None else (lambda c: fixed_point_sum(c, scale) / F.count(c))
    return weather.groupBy(week_start(date_col).alias("week")).agg(
        *[round_half_up(mean(c), d).alias(c) for c, d in rounding.items()])


def weekly_days_since_change(daily: DataFrame, product_col: str = "product_code", date_col: str = "date",
                             flag_col: str = "price_change", days_col: str = "days_since_last_change") -> DataFrame:
    """Per product and Monday week: 0 when the price changed on the week's first day, else the
    last days-since-change value of the week."""
    wk = week_start(date_col)
    return daily.groupBy(product_col, wk.alias("week")).agg(
        F.when(F.min_by(F.col(flag_col).cast("int"), date_col) == 1, F.lit(0))
        .otherwise(F.max_by(days_col, date_col)).alias(days_col))
