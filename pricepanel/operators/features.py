"""Feature engineering on the product-day panel: lags, price changes, fills, runs, competitors.

All lags of all columns are produced in one ``select`` so the plan has a single
Window node per partitioning (one sort per product), and windows run on the
product-day panel, whose partitions are bounded by the number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rowwise as rw
from ..functions.scalars import ratio


def add_lags(df: DataFrame, cols: Sequence[str], lags: Sequence[int], product_col: str = "product_code",
             order_col: str = "date", tiebreak: Sequence[str] = ()) -> DataFrame:
    """``{col}_lag_{k}``: value k rows earlier within the product (row lag, not calendar).

    ``tiebreak`` orders rows of one product and date; without it they should be one row.
    """
    w = Window.partitionBy(product_col).orderBy(order_col, *tiebreak)
    new = [F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for c in cols if c in df.columns for k in lags]
    return df.select("*", *new)


def add_price_changes(df: DataFrame, cols: Sequence[str], lags: Sequence[int]) -> DataFrame:
    """``price_change_{col}_lag_{k}`` = (x - lag) / lag * 100; zero lag -> NULL."""
    new = {f"price_change_{c}_lag_{k}": ratio(F.col(c) - F.col(f"{c}_lag_{k}"), F.col(f"{c}_lag_{k}")) * 100
           for c in cols for k in lags if f"{c}_lag_{k}" in df.columns}
    return df.withColumns(new)


def ffill_columns(df: DataFrame, cols: Sequence[str], product_col: str = "product_code",
                  order_col: str = "date", tiebreak: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(product_col).orderBy(order_col, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols if c in df.columns})


def add_price_runs(df: DataFrame, price_col: str = "product_selling_price", product_col: str = "product_code",
                   order_col: str = "date", tiebreak: Sequence[str] = ()) -> DataFrame:
    """price_change flag, run id, rows since the last change and weeks (= rows // 7)."""
    w = Window.partitionBy(product_col).orderBy(order_col, *tiebreak)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    flag = F.coalesce(F.col(price_col) != F.lag(price_col).over(w), F.lit(False))
    # row numbers instead of a window per run: one order, so the rows are sorted once
    staged = df.withColumns({"price_change": flag, "_rn": F.row_number().over(w)}).withColumns({
        "price_change_group": F.sum(F.col("price_change").cast("int")).over(so_far),
        "_began": F.max(F.when(F.col("price_change"), F.col("_rn"))).over(so_far)})
    return (staged.withColumn("days_since_last_change", F.col("_rn") - F.coalesce("_began", F.lit(1)))
            .withColumn("weeks_since_last_change", F.floor(F.col("days_since_last_change") / 7).cast("int"))
            .drop("_rn", "_began"))


def add_competitor_features(df: DataFrame, competitors: Sequence[str], price_col: str = "product_selling_price",
                            ffill: bool = True, product_col: str = "product_code", order_col: str = "date") -> DataFrame:
    """Distances to each competitor, to the cheapest / dearest, their names, mean distance,
    counts and the geometric competitor price index with log features."""
    comp_cols = [f"{c}_price" for c in competitors if f"{c}_price" in df.columns]
    present = [c for c in competitors if f"{c}_price" in df.columns]
    out = ffill_columns(df, comp_cols, product_col, order_col) if ffill else df
    if not comp_cols:
        return out
    dist = {f"price_distance_{c}": rw.symmetric_distance(price_col, f"{c}_price") for c in present}
    out = out.withColumns(dist)
    dcols = list(dist)
    out = out.withColumns({
        "cheapest_competitor": rw.cheapest_name(comp_cols, present),
        "most_expensive_competitor": rw.dearest_name(comp_cols, present),
        "price_distance_cheapest": rw.symmetric_distance(F.col(price_col), rw.row_min(comp_cols)),
        "price_distance_most_expensive": rw.symmetric_distance(F.col(price_col), rw.row_max(comp_cols)),
        "price_distance_mean": rw.row_mean(dcols),
        "n_competitors_cheaper": rw.count_positive(dcols),
        "n_competitors_available": rw.count_present(dcols),
        "comp_price_index": rw.geometric_mean_positive(comp_cols),
    })
    return out.withColumns({
        "log_own_price": rw.safe_log(price_col),
        "log_comp_index": rw.safe_log("comp_price_index"),
    }).withColumn("log_relative_price", F.col("log_own_price") - F.col("log_comp_index"))


def cast_feature_types(df: DataFrame, bool_cols: Sequence[str] = ("promotion_indicator",)) -> DataFrame:
    """Booleans as boolean (NULL -> false); categories stay strings until the model boundary."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in bool_cols if c in df.columns})


def round_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    from ..functions.scalars import round_half_up
    return df.select(*[round_half_up(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
