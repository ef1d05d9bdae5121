"""Train/test split, price grid and counterfactual expansion.

The grid is built from the same reference rows as the test set and matched on
(product, date), not by list position.  Expansion multiplies rows by the grid
size (21 for +-10 %): the columns are projected before ``posexplode`` and no
join is needed when the grid is derived from the test rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rowwise as rw
from ..functions.scalars import price_ladder, ratio


def split_train_test(df: DataFrame, n_days: int = 14, test_end: str | None = None,
                     product_col: str = "product_code", date_col: str = "date") -> DataFrame:
    """``is_test``: a fixed window [test_end - n + 1, test_end], else the last n days of each product."""
    d = F.col(date_col)
    if test_end is not None:
        end = F.lit(test_end).cast("date")
        is_test = (d >= F.date_sub(end, n_days - 1)) & (d <= end)
    else:
        is_test = d >= F.date_sub(F.max(date_col).over(Window.partitionBy(product_col)), n_days - 1)
    return df.withColumn("is_test", is_test)


def reference_rows(df: DataFrame, n: int = 14, test_end: str | None = None, product_col: str = "product_code",
                   date_col: str = "date") -> DataFrame:
    """Rows the grid is built from: the test window when ``test_end`` is set, else the last n rows."""
    if test_end is not None:
        return split_train_test(df, n, test_end, product_col, date_col).filter("is_test").drop("is_test")
    w = Window.partitionBy(product_col).orderBy(F.col(date_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def with_sequence(df: DataFrame, product_col: str = "product_code", date_col: str = "date") -> DataFrame:
    """0-based day index of each row within its product (same numbering on every side)."""
    w = Window.partitionBy(product_col).orderBy(date_col)
    return df.withColumn("sequence_number", F.row_number().over(w) - 1)


def actual_by_sequence(predictions: DataFrame, actual: DataFrame, price_col: str = "product_selling_price",
                       product_col: str = "product_code", date_col: str = "date") -> DataFrame:
    """Predictions LEFT JOIN the actual price of the same (product, 0-based day index): ``{price_col}_calc``
    beside ``{price_col}_real``.  ``predictions`` carry ``sequence_number``; both sides number alike."""
    real = with_sequence(actual, product_col, date_col).select(
        product_col, "sequence_number", F.col(price_col).alias(f"{price_col}_real"))
    return predictions.withColumnRenamed(price_col, f"{price_col}_calc").join(real, [product_col, "sequence_number"], "left")


def price_grid(ref_rows: DataFrame, min_pct: int = -10, max_pct: int = 10, price_col: str = "product_selling_price",
               product_col: str = "product_code", date_col: str = "date") -> DataFrame:
    """(product, date, sequence_number, prices array<double>) for every reference row with price > 0."""
    seq = with_sequence(ref_rows, product_col, date_col)
    return (seq.filter(F.col(price_col) > 0)
            .select(product_col, date_col, "sequence_number",
                    price_ladder(price_col, min_pct, max_pct).alias("prices")))


def expand_counterfactual(test_rows: DataFrame, grid: DataFrame | None = None, min_pct: int = -10,
                          max_pct: int = 10, price_col: str = "product_selling_price",
                          lag_cols: dict[int, Sequence[str]] | None = None, promo_col: str = "promotion_indicator",
                          product_col: str = "product_code", date_col: str = "date",
                          scaled_cols: Sequence[str] = ()) -> DataFrame:
    """Test row x its grid: own price := simulated price; ``sequence_number`` = day index;
    every lag k <= sequence_number := simulated price; promotion := false.

    ``scaled_cols`` are further price columns (e.g. the adjusted price): they are scaled by simulated /
    actual price, and so are their lags k <= sequence_number (``{col}_lag_{k}`` in ``lag_cols``), so no
    real price of a simulated day is left in the row.
    """
    if grid is None:
        # grid derived from the test rows themselves: computed in place, no self-join
        rows = (with_sequence(test_rows, product_col, date_col).filter(F.col(price_col) > 0)
                .withColumn("prices", price_ladder(price_col, min_pct, max_pct)))
    else:
        rows = test_rows.join(grid, [product_col, date_col])
    scaled = [c for c in scaled_cols if c in rows.columns and c != price_col]
    other = [c for c in rows.columns if c not in ("prices", price_col)]
    out = rows.select(*other, F.col(price_col).alias("_actual"), F.posexplode("prices").alias("grid_idx", price_col))
    simulated = {price_col: F.col(price_col)} | {c: F.col(c) * ratio(price_col, "_actual") for c in scaled}
    updates = {c: simulated[c] for c in scaled}
    for k, cols in (lag_cols or {}).items():
        for c in cols:
            if c in out.columns:
                own = simulated.get(c.rpartition("_lag_")[0], F.col(price_col))
                updates[c] = F.when(F.lit(k) <= F.col("sequence_number"), own).otherwise(F.col(c))
    if promo_col in out.columns:
        updates[promo_col] = F.lit(False)
    return (out.withColumns(updates) if updates else out).drop("_actual")


def resimulate_features(df: DataFrame, price_cols: Sequence[str], lags: Sequence[int], competitors: Sequence[str],
                        price_col: str = "product_selling_price") -> DataFrame:
    """Recompute price changes from the (overwritten) lags and drop the lags; recompute the
    distances, their aggregates and the log features for the simulated own price."""
    out = df
    lag_names = []
    for c in price_cols:
        for k in lags:
            lag = f"{c}_lag_{k}"
            if lag in out.columns:
                out = out.withColumn(f"price_change_{c}_lag_{k}", ratio(F.col(c) - F.col(lag), F.col(lag)) * 100)
                lag_names.append(lag)
    out = out.drop(*lag_names)
    present = [c for c in competitors if f"{c}_price" in out.columns]
    comp_cols = [f"{c}_price" for c in present]
    if present:
        dist = {f"price_distance_{c}": rw.symmetric_distance(price_col, f"{c}_price") for c in present}
        out = out.withColumns(dist)
        out = out.withColumns({
            "price_distance_cheapest": rw.symmetric_distance(F.col(price_col), rw.row_min(comp_cols)),
            "price_distance_most_expensive": rw.symmetric_distance(F.col(price_col), rw.row_max(comp_cols)),
            "price_distance_mean": rw.row_mean(list(dist)),
            "n_competitors_cheaper": rw.count_positive(list(dist)),
            "n_competitors_available": rw.count_present(list(dist)),
        })
    if "log_own_price" in out.columns:
        out = out.withColumn("log_own_price", rw.safe_log(price_col))
        if "log_comp_index" in out.columns:
            out = out.withColumn("log_relative_price", F.col("log_own_price") - F.col("log_comp_index"))
    return out
