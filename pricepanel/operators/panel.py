"""Receipt -> product-day panel operators (weighted goods, store followers, store counts, roll-up).

Scale notes
-----------
* ``rolling_unique_stores`` never collects store sets in a sliding frame.  Each
  (product, store) sale makes the store visible for ``n`` days; where such a
  stretch begins or ends (seen from the days before and after, a window bounded
  by the days of that pair) is a +1/-1 event, pre-aggregated per (product, day)
  and summed with a running window per product whose rows are bounded by the
  number of calendar days, not by the data volume.  One pass serves all lengths.
* ``store_price_correlation`` is one grouped aggregate of sufficient
  statistics (covariance / std-devs), with partial aggregation before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_date, ratio, round_half_up


def fix_weighted_products(df: DataFrame, price_col: str = "calculated_price", qty_col: str = "quantity_sold",
                          weight_col: str = "weight_sold", selling_col: str = "product_selling_price",
                          equal_col: str | None = None) -> DataFrame:
    """Price per weight unit for goods sold by weight, else the selling price; 2 dp.

    ``equal_col`` names a flag to add: whether the result equals the selling price.
    """
    fixed = F.when(F.col(weight_col) > 0, ratio(F.col(price_col) * F.col(qty_col), F.col(weight_col))) \
        .otherwise(F.col(selling_col))
    out = df.withColumn(price_col, round_half_up(fixed, 2))
    return out.withColumn(equal_col, F.col(price_col) == F.col(selling_col)) if equal_col else out


def select_rows(df: DataFrame, cutoff: str | None = None, price_col: str = "product_selling_price",
                qty_col: str = "quantity_sold", date_code_col: str = "date_code") -> DataFrame:
    """Non-NULL price, quantity > 0 and, if one is given, date <= cutoff; parses ``date_code`` into ``date``."""
    out = df.filter(F.col(price_col).isNotNull() & (F.col(qty_col) > 0)).withColumn("date", parse_date(date_code_col))
    return out if cutoff is None else out.filter(F.col("date") <= F.lit(cutoff).cast("date"))


def store_day_aggregate(df: DataFrame, keys: Sequence[str] = ("product_code", "date", "store_code")) -> DataFrame:
    """product-store-day: mean selling price, mean list price, summed quantity."""
    return df.groupBy(*keys).agg(
        F.avg("product_selling_price").alias("product_selling_price_mean"),
        F.avg("calculated_price").alias("calculated_price_mean"),
        F.sum("quantity_sold").alias("quantity_sold_sum"))


def store_price_changes(store_day: DataFrame) -> DataFrame:
    """Lag-1 per (product, store) by date and the x100 price changes (2 dp); change != 0 kept."""
    w = Window.partitionBy("product_code", "store_code").orderBy("date")
    return (store_day
            .withColumn("product_selling_price_change",
                        round_half_up((F.col("product_selling_price_mean")
                                       - F.lag("product_selling_price_mean").over(w)) * 100, 2))
            .withColumn("calculated_price_price_change",
                        round_half_up((F.col("calculated_price_mean")
                                       - F.lag("calculated_price_mean").over(w)) * 100, 2))
            .filter(F.col("product_selling_price_change") != 0))


def pearson(x, y):
    """Population Pearson correlation; NULL (not an error) when one side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def store_price_correlation(changes: DataFrame, min_corr: float = 0.9) -> DataFrame:
    """(product, store) pairs whose selling price follows the list price: n > 1 and corr > min_corr."""
    return (changes.groupBy("product_code", "store_code")
            .agg(F.count(F.lit(1)).alias("n_changes"),
                 pearson(F.col("product_selling_price_change"), F.col("calculated_price_price_change")).alias("corr"))
            .filter((F.col("n_changes") > 1) & (F.col("corr") > min_corr)))


def select_store_followers(receipts: DataFrame, cutoff: str | None = None, min_corr: float = 0.9) -> DataFrame:
    """Keep receipt rows of (product, store) pairs that follow the list price."""
    pairs = store_price_correlation(store_price_changes(store_day_aggregate(select_rows(receipts, cutoff))), min_corr)
    return receipts.join(pairs.select("product_code", "store_code"), ["product_code", "store_code"], "left_semi")


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (aggregate, not a window)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``drop_duplicates(subset, keep='last')`` with an explicit order."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def rolling_unique_stores(df: DataFrame, days, product_col: str = "product_code",
                          store_col: str = "store_code", date_col: str = "date") -> DataFrame:
    """Distinct stores selling a product in the day range (t-n, t], for every (product, t) present,
    for one window length or several (one output column ``unique_stores_last_{n}_days`` each).

    All window lengths share one distinct pass, one event aggregation and one running window.
    Rows with a NULL store or date are not counted.
    """
    lengths = [days] if isinstance(days, int) else list(days)
    seen = df.filter(F.col(store_col).isNotNull() & F.col(date_col).isNotNull()).select(
        product_col, store_col, F.col(date_col).alias("_day")).distinct()
    pair = Window.partitionBy(product_col, store_col).orderBy("_day")
    since = F.datediff(F.col("_day"), F.lag("_day").over(pair))
    until = F.datediff(F.lead("_day").over(pair), F.col("_day"))
    gaps = seen.select(product_col, "_day", since.alias("_since"), until.alias("_until"))

    def event(day, present, length=None, delta=None):
        """Change of the store count by length on a day; only ``length`` changes by ``delta``."""
        first = F.coalesce(F.col("_since"), F.lit(1 << 30))
        own = [delta if n == length else F.lit(0) for n in lengths] if length else [(first >= n).cast("int") for n in lengths]
        return F.struct(day.alias("_day"), F.lit(present).alias("_present"), *[d.alias(f"_d{n}") for n, d in zip(lengths, own)])

    # a store comes into sight on a day it was not seen for n days before, and goes n days after its last one
    goes = [event(F.date_add("_day", n), False, n, F.when(F.coalesce(F.col("_until") >= n, F.lit(True)), -1).otherwise(0))
            for n in lengths]
    events = gaps.select(product_col, F.explode(F.array(event(F.col("_day"), True), *goes)).alias("_e")).select(
        product_col, "_e.*")
    per_day = events.groupBy(product_col, "_day").agg(
        *[F.sum(f"_d{n}").alias(f"_d{n}") for n in lengths], F.bool_or("_present").alias("_present"))
    run = Window.partitionBy(product_col).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    out = per_day.withColumns({f"unique_stores_last_{n}_days": F.sum(f"_d{n}").over(run).cast("bigint")
                               for n in lengths})
    return out.filter("_present").select(F.col(product_col), F.col("_day").alias(date_col),
                                         *[f"unique_stores_last_{n}_days" for n in lengths])


SUM_COLS = ("quantity_sold", "revenue_before_discount_incl_vat")
MEAN_COLS = ("calculated_price", "calculated_price_after_discount")
FIRST_COLS = ("product_selling_price", "product_category_code_level1", "product_category_code_level2",
              "product_category_code_level3", "product_status", "promo_ind", "ah_price", "plus_price",
              "plus_content_factor", "ah_content_factor", "brand_name")


def product_day_rollup(receipts: DataFrame, windows: Sequence[int] = (7, 30), tiebreak: Sequence[str] | None = None,
                       sum_cols: Sequence[str] = SUM_COLS, mean_cols: Sequence[str] = MEAN_COLS,
                       first_cols: Sequence[str] = FIRST_COLS) -> DataFrame:
    """Receipts -> product-day rows: rolling store counts, sums, means and values of the first store.

    One row per (date, product, store) is kept first: the smallest by ``tiebreak`` (default: all other
    columns in turn), so the result does not depend on the row order.  Columns that the receipts lack are
    left out.  A sum over NULLs alone is 0.
    """
    raw = receipts.withColumn("date", parse_date("date_code"))
    keys = ["date", "product_code", "store_code"]
    order = list(tiebreak) if tiebreak is not None else [c for c in raw.columns if c not in keys]
    rows = dedupe_keep_first(raw, keys, order)
    have = lambda cols: [c for c in cols if c in receipts.columns]
    # the first store's values in one struct: all come from the same row
    per_day = rows.groupBy("product_code", "date").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast(receipts.schema[c].dataType)).alias(c) for c in have(sum_cols)],
        *[F.avg(c).alias(c) for c in have(mean_cols)],
        F.min_by(F.struct(*have(first_cols)), "store_code").alias("_first"))
    # distinct (product, store, date) triples are the same before and after the keep-first dedupe
    return per_day.join(rolling_unique_stores(raw, list(windows)), ["product_code", "date"], "left").select(
        "product_code", "date", *have(sum_cols), *[f"unique_stores_last_{n}_days" for n in windows],
        *[F.col(f"_first.{c}").alias(c) for c in have(first_cols)], *have(mean_cols))
