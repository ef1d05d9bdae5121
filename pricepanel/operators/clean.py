"""Panel cleaning operators (column hygiene, product filters, outliers, runs, bounded fill).

Product-level filters (price levels, low sellers, IQR fences, live products)
are expressed as window aggregates partitioned by ``product_code`` over the
product-day panel: a product holds at most one row per calendar day, so each
partition is bounded by the calendar length whatever the data volume, and the
filter needs no second shuffle for a semi join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio

# The input column aliases accepted by the reference, in its order.
COLUMN_ALIASES: dict[str, str] = {
    "nr_of_stores_per_month": "number_of_stores",
    "promotion_ind": "promotion_indicator",
    "promo_ind": "promotion_indicator",
    "product_category_code_level1": "category_code_level1",
    "product_category_code_level2": "category_code_level2",
    "product_category_code_level3": "category_code_level3",
    "product_category_name_level1": "category_name_level1",
    "product_category_name_level2": "category_name_level2",
    "product_category_name_level3": "category_name_level3",
    "product_category_level1": "category_name_level1",
    "product_category_level2": "category_name_level2",
    "product_category_level3": "category_name_level3",
    "revenue_after_discount_incl_vat": "revenue_after",
    "revenue_before_discount_incl_vat": "revenue_before",
    "albert_heijn_price": "ah_price",
    "total_quantity_sold": "quantity_sold",
    "total_revenue_before_discount": "revenue_before",
    "total_revenue_after_discount": "revenue_after",
    "number_of_stores_per_week": "number_of_stores",
    "category_level_4": "category_name_level4",
    "category_level_3": "category_name_level3",
    "category_level_2": "category_name_level2",
    "category_level_1": "category_name_level1",
}


def rename_columns(df: DataFrame, aliases: Mapping[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Rename known aliases (schema-only, no data pass)."""
    present = {k: v for k, v in aliases.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def deduplicate_column_names(df: DataFrame) -> DataFrame:
    """Suffix repeated column names with _2, _3, ... (schema-only)."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        seen[c] = seen.get(c, 0) + 1
        names.append(c if seen[c] == 1 else f"{c}_{seen[c]}")
    return df.toDF(*names)


def derive_price(df: DataFrame, price_col: str = "product_selling_price",
                 qty_col: str = "quantity_sold") -> DataFrame:
    """price = revenue / quantity when no price column exists (revenue_after preferred)."""
    if price_col in df.columns:
        return df
    rev = "revenue_after" if "revenue_after" in df.columns else "revenue_before"
    return df.withColumn(price_col, ratio(rev, qty_col))


# Columns that are dropped for every client.
STANDARD_DROPS = ["category_code_level1", "category_code_level2", "category_code_level3", "category_name"]


def drop_columns(df: DataFrame, names: Sequence[str] = (), standard: Sequence[str] = STANDARD_DROPS) -> DataFrame:
    """Drop the standard columns and a client's own, where present."""
    return df.drop(*standard, *names)


def filter_status(df: DataFrame, vocabulary: Sequence[str] | None = ("Active",), status_col: str = "product_status") -> DataFrame:
    """Keep products whose status is in the vocabulary (no-op when it is None or the column is absent)."""
    if vocabulary is None or status_col not in df.columns:
        return df
    return df.filter(F.col(status_col).isin(list(vocabulary)))


def filter_channel(df: DataFrame, channel: str | None, channel_col: str = "store_priceline_code") -> DataFrame:
    return df if channel is None else df.filter(F.col(channel_col) == channel)


def drop_missing_categories(df: DataFrame) -> DataFrame:
    """Drop rows with NULL in any column whose name contains 'category'."""
    cats = [c for c in df.columns if "category" in c]
    return df.dropna(subset=cats) if cats else df


def filter_non_negative(df: DataFrame, cols: Sequence[str] = ("quantity_sold", "revenue_before")) -> DataFrame:
    """Keep rows whose measures are >= 0; NULL passes."""
    cond = F.lit(True)
    for c in cols:
        if c in df.columns:
            cond = cond & (F.col(c).isNull() | (F.col(c) >= 0))
    return df.filter(cond)


def filter_valid_price(df: DataFrame, price_col: str = "product_selling_price") -> DataFrame:
    """Drop NULL / infinite / negative prices."""
    p = F.col(price_col)
    return df.filter(p.isNotNull() & (p >= 0) & (p != float("inf")))


def impute_price_when_unsold(df: DataFrame, price_col: str = "calculated_price",
                             fallback_col: str = "product_selling_price", qty_col: str = "quantity_sold") -> DataFrame:
    """Use the selling price where nothing was sold and the price is missing."""
    q = F.col(qty_col)
    return df.withColumn(price_col, F.when((q.isNull() | (q == 0)) & F.col(price_col).isNull(), F.col(fallback_col))
                         .otherwise(F.col(price_col)))


def _by_product(product_col: str) -> Window:
    return Window.partitionBy(product_col)


def filter_price_levels(df: DataFrame, min_levels: int = 5, product_col: str = "product_code",
                        price_col: str = "product_selling_price") -> DataFrame:
    """Keep products with at least ``min_levels`` distinct non-NULL prices (grouped count + semi join)."""
    keep = (df.groupBy(product_col).agg(F.count_distinct(price_col).alias("_levels"))
            .filter(F.col("_levels") >= min_levels).select(product_col))
    return df.join(keep, product_col, "left_semi")


def product_medians(df: DataFrame, target_col: str = "quantity_sold", product_col: str = "product_code") -> DataFrame:
    return df.groupBy(product_col).agg(F.median(target_col).alias("_median"))


def filter_low_sellers(df: DataFrame, min_sales: float, target_col: str = "quantity_sold",
                       product_col: str = "product_code") -> DataFrame:
    """Semi-join form: keep products whose median target >= min_sales (NULL median dropped)."""
    keep = product_medians(df, target_col, product_col).filter(F.col("_median") >= min_sales)
    return df.join(keep.select(product_col), product_col, "left_semi")


def remove_low_sellers(df: DataFrame, min_sales: float, target_col: str = "quantity_sold",
                       product_col: str = "product_code") -> DataFrame:
    """Anti-join form: remove products whose median target < min_sales (NULL median survives)."""
    low = product_medians(df, target_col, product_col).filter(F.col("_median") < min_sales)
    return df.join(low.select(product_col), product_col, "left_anti")


def filter_iqr(df: DataFrame, product_col: str = "product_code", price_col: str = "product_selling_price",
               multiplier: float = 2.0) -> DataFrame:
    """Keep max(Q1 - k*IQR, 0) <= price <= Q3 + k*IQR per product (exact quartiles); NULL price dropped."""
    w = _by_product(product_col)
    q = F.percentile(F.col(price_col), F.array(F.lit(0.25), F.lit(0.75))).over(w)
    staged = df.withColumn("_q", q)
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    iqr = q3 - q1
    lower = F.greatest(q1 - F.lit(multiplier) * iqr, F.lit(0.0))
    upper = q3 + F.lit(multiplier) * iqr
    return staged.filter((F.col(price_col) >= lower) & (F.col(price_col) <= upper)).drop("_q")


def filter_live_products(df: DataFrame, days: int = 180, product_col: str = "product_code",
                         date_col: str = "date") -> DataFrame:
    """Keep products with a row on or after max(date) - days.

    The global maximum is a scalar subquery over the per-product maxima (no join)."""
    last = df.groupBy(product_col).agg(F.max(date_col).alias("_last"))
    gmax = last.agg(F.max("_last")).scalar()  # uncorrelated scalar subquery, computed once
    live = last.filter(F.col("_last") >= F.date_sub(gmax, days)).select(product_col)
    return df.join(live, product_col, "left_semi")


def _with_run_length(df: DataFrame, kind, limit: int, product_col: str, order_col: str, tiebreak: Sequence[str]) -> DataFrame:
    """Adds ``_run``: on rows where ``kind`` holds, how many such rows stand together; NULL if more than ``limit`` follow.

    All windows share one order, so the rows are sorted once: the last other row is carried along, the next one is
    sought among the following ``limit`` rows (the cost of a row), and the end of the product ends a run as well.
    """
    w = Window.partitionBy(product_col).orderBy(order_col, *tiebreak)
    ahead = w.rowsBetween(0, limit)
    other = F.when(~F.col("_kind"), F.col("_rn"))
    staged = df.withColumns({"_kind": kind, "_rn": F.row_number().over(w)}).withColumns({
        "_before": F.max(other).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_next": F.min(other).over(ahead), "_seen": F.count(F.lit(1)).over(ahead)})
    after = F.coalesce("_next", F.when(F.col("_seen") <= limit, F.col("_rn") + F.col("_seen")))
    run = after - F.coalesce("_before", F.lit(0)) - 1
    return staged.withColumn("_run", run).drop("_rn", "_before", "_next", "_seen")


def remove_zero_runs(df: DataFrame, run_length: int = 7, product_col: str = "product_code",
                     order_col: str = "date", qty_col: str = "quantity_sold", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Gaps-and-islands: drop runs of >= run_length consecutive zero/NULL quantity rows; NULL -> 0.

    ``tiebreak`` orders rows of one product and date; without it they should be one row.
    """
    zero = (F.col(qty_col).isNull() | (F.col(qty_col) == 0))
    staged = _with_run_length(df, zero, run_length, product_col, order_col, tiebreak)
    return (staged.filter(~F.col("_kind") | F.coalesce(F.col("_run") < run_length, F.lit(False)))
            .withColumn(qty_col, F.coalesce(F.col(qty_col), F.lit(0).cast(df.schema[qty_col].dataType)))
            .drop("_kind", "_run"))


def bounded_ffill(df: DataFrame, col_name: str, max_fill: int = 2, product_col: str = "product_code",
                  order_col: str = "date", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Forward-fill NULL runs of at most ``max_fill`` rows; longer and leading runs stay NULL."""
    w = Window.partitionBy(product_col).orderBy(order_col, *tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    staged = _with_run_length(df, F.col(col_name).isNull(), max_fill, product_col, order_col, tiebreak)
    return (staged.withColumn("_prev", F.last(col_name, ignorenulls=True).over(w))
            .withColumn(col_name, F.when(F.col("_kind") & (F.col("_run") <= max_fill), F.col("_prev"))
                        .otherwise(F.col(col_name)))
            .drop("_kind", "_run", "_prev"))


def add_output_metadata(df: DataFrame, **constants) -> DataFrame:
    """Constant metadata columns (priceline, channel, client)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def map_values(df: DataFrame, col_name: str, mapping: DataFrame, key_col: str = "key", value_col: str = "value",
               out_col: str | None = None) -> DataFrame:
    """Dictionary lookup (unmapped -> NULL).  A key given twice takes its smallest value, so rows never
    fan out; the optimizer's size estimate decides whether the mapping is broadcast."""
    m = mapping.groupBy(F.col(key_col).alias("_mk")).agg(F.min(value_col).alias(out_col or col_name))
    if out_col is None:
        df = df.withColumnRenamed(col_name, "_mv_in")
        return df.join(m, F.col("_mv_in") == F.col("_mk"), "left").drop("_mk", "_mv_in")
    return df.join(m, F.col(col_name) == F.col("_mk"), "left").drop("_mk")


def merge_product_names(sales: DataFrame, names: DataFrame, product_col: str = "product_code") -> DataFrame:
    """sales LEFT JOIN product names; of several name rows of a product the smallest whole row is taken."""
    rest = [c for c in names.columns if c != product_col]
    first = names.groupBy(product_col).agg(F.min(F.struct(*rest)).alias("_names"))
    return sales.join(first, product_col, "left").select(*sales.columns, *[F.col(f"_names.{c}").alias(c) for c in rest])


def sequence_modulo(df: DataFrame, n: int, product_col: str = "product_code", date_col: str = "date") -> DataFrame:
    """1-based row number within the product modulo n, with 0 shown as n."""
    w = Window.partitionBy(product_col).orderBy(date_col)
    return df.withColumn("sequence_number", F.pmod(F.row_number().over(w) - 1, F.lit(n)) + 1)


def zero_except_middle(df: DataFrame, col_name: str, product_col: str = "product_code",
                       date_col: str = "date") -> DataFrame:
    """Set ``col_name`` to 0 on every row but the middle one (index n // 2) of each product."""
    w = Window.partitionBy(product_col).orderBy(date_col)
    n = F.count(F.lit(1)).over(Window.partitionBy(product_col))
    mid = F.row_number().over(w) == F.floor(n / 2) + 1
    return df.withColumn(col_name, F.when(mid, F.col(col_name)).otherwise(F.lit(0).cast(df.schema[col_name].dataType)))
