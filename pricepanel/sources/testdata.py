"""Canonical retail tables derived from the driver's TPC-H-like parquet tables.

The driver ships no retail data, so the canonical shapes of FIXTURES.md are
derived here, lazily, from ``lineitem`` / ``part`` / ``supplier`` / ``nation`` /
``region`` / ``orders`` / ``events``.  Every function returns a DataFrame whose
work grows with the input tables; nothing is materialised.

Mapping (one line each):

* product (sparse) = ``l_partkey`` as string; product (dense) = ``p_brand``
* date = ``l_shipdate`` as date; quantity = ``l_quantity``
* selling price = ``l_extendedprice / l_quantity``
* revenue before / after discount = ``l_extendedprice`` / ``l_extendedprice * (1 - l_discount)``
* promotion = ``l_discount > 0``; store = ``l_suppkey``; status = ``l_linestatus``
* competitor = the supplier's region name; categories = ``p_type`` / ``p_size``
* monthly index (CPI stand-in) = monthly mean ``o_totalprice`` / 1000
* tie-break for every ordering = (``l_orderkey``, ``l_linenumber``)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fixed_point_sum, ratio, round_half_up, to_day

TIEBREAK = ["l_orderkey", "l_linenumber"]
#: Line items that one task of a product panel takes; a product's weeks or simulated prices are some ten times its lines.
TASK_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Line-grain sales rows (product = part), with ``more`` columns of the line items."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("product_code"),
        F.col("l_suppkey").alias("store_code"),
        to_day("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity_sold"),
        ratio("l_extendedprice", "l_quantity").alias("product_selling_price"),
        F.col("l_extendedprice").alias("revenue_before"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue_after"),
        (F.col("l_discount") > 0).alias("promotion_indicator"),
        F.col("l_discount").alias("discount"),
        F.col("l_linestatus").alias("product_status"),
        F.col("l_returnflag").alias("return_flag"),
        "l_orderkey", "l_linenumber", *more,
    )


def spread(spark: SparkSession, sf_dir: str, rows: DataFrame, *keys: str) -> DataFrame:
    """Rows (as many as line items at most) hashed by ``keys`` into tasks of about ``TASK_ROWS`` line items.

    Their number follows the table (its rows are counted from the files' footers) and never falls below the session's,
    so a task's memory does not grow with the input; what is grouped or ordered by (at least) the keys afterwards needs
    no further shuffle.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(parts, table(spark, sf_dir, "lineitem").count() // TASK_ROWS), *keys)


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension: partkey -> categories, brand, list price."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_type").alias("category_name_level1"),
        F.col("p_size").cast("string").alias("category_name_level2"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_retailprice").alias("recommended_retail_price"),
    )


def sales_with_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the optimizer's size estimate decides broadcast vs. shuffle join; no hint
    return sales_rows(spark, sf_dir).join(part_dim(spark, sf_dir), "product_code", "left")


def _day_agg(rows: DataFrame, key: str = "product_code") -> DataFrame:
    return (rows.groupBy(key, "date")
            .agg(F.sum("quantity_sold").alias("quantity_sold"),
                 fixed_point_sum("revenue_before", 2).alias("revenue_before"),
                 fixed_point_sum("revenue_after", 4).alias("revenue_after"),
                 F.bool_or("promotion_indicator").alias("promotion_indicator"),
                 F.count(F.lit(1)).alias("n_lines"))
            .withColumn("product_selling_price", ratio("revenue_before", "quantity_sold")))


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-day panel, product = part: unique (product_code, date).

    Lines of a part on one day are few, so the rows are shuffled as they are, once, by product: the days, weeks, runs
    and curves of a product follow in the same task.
    """
    return _day_agg(spread(spark, sf_dir, sales_rows(spark, sf_dir), "product_code"))


def brand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales_rows(spark, sf_dir, "l_partkey").withColumnRenamed("product_code", "part_code")
    brands = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("product_code"))
    # joined by the whole number: the same shuffle as that of the competitor prices, no text made of it
    return rows.join(brands, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


def brand_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense product-day panel, product = brand."""
    return _day_agg(brand_rows(spark, sf_dir))


def region_of_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) are fixed-size reference tables
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "r_name")
    return table(spark, sf_dir, "supplier").join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey")) \
        .select(F.col("s_suppkey"), F.col("r_name"))


def competitor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long competitor price table: (brand, region, day, price) per line item."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .join(region_of_supplier(spark, sf_dir), li.l_suppkey == F.col("s_suppkey"))
            .select(F.col("p_brand").alias("product_code"),
                    F.col("r_name").alias("competitor_name"),
                    to_day("l_shipdate").alias("price_date"),
                    ratio("l_extendedprice", "l_quantity").alias("normalized_price"),
                    "l_orderkey", "l_linenumber"))


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-store-day receipt rows (FIXTURES §2 shape); product = brand, store = supplier."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_name", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("p_brand").alias("product_code"),
        F.col("l_suppkey").alias("store_code"),
        F.date_format(to_day("l_shipdate"), "yyyyMMdd").alias("date_code"),
        F.col("l_quantity").alias("quantity_sold"),
        # line 7 of an order is sold by weight (tax x 10 as kilograms)
        F.when(F.col("l_linenumber") == 7, F.col("l_tax") * 10).otherwise(F.lit(0.0)).alias("weight_sold"),
        ratio("l_extendedprice", "l_quantity").alias("product_selling_price"),
        ratio(F.col("l_extendedprice") * (1 - F.col("l_discount")), "l_quantity").alias("calculated_price"),
        F.col("l_extendedprice").alias("revenue_before_discount_incl_vat"),
        (F.col("l_discount") > 0).alias("promo_ind"),
        F.col("l_linestatus").alias("product_status"),
        round_half_up(ratio(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), "l_quantity"), 2)
        .alias("calculated_price_after_discount"),
        F.col("p_type").alias("product_category_code_level1"),
        F.col("p_size").cast("string").alias("product_category_code_level2"),
        F.col("p_name").alias("product_category_code_level3"),
        # two competitors' list prices; unknown for returned lines
        F.when(F.col("l_returnflag") != "R", F.col("p_retailprice")).alias("ah_price"),
        F.col("l_tax").alias("ah_content_factor"),
        (F.col("p_retailprice") * 2).alias("plus_price"),
        F.col("l_discount").alias("plus_content_factor"),
        F.substring("p_brand", 1, 7).alias("brand_name"),
        "l_orderkey", "l_linenumber",
    )


def monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly price index (CPI stand-in): mean order total per month / 1000."""
    o = table(spark, sf_dir, "orders")
    m = F.trunc(to_day("o_orderdate"), "month")
    return (o.groupBy(m.alias("month_year"))
            .agg((fixed_point_sum("o_totalprice", 2) / F.count(F.lit(1)) / 1000).alias("cpi")))


def monthly_index_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category monthly index: category = order priority."""
    o = table(spark, sf_dir, "orders")
    m = F.trunc(to_day("o_orderdate"), "month")
    return (o.groupBy(F.col("o_orderpriority").alias("category_name"), m.alias("month_year"))
            .agg((fixed_point_sum("o_totalprice", 2) / F.count(F.lit(1)) / 1000).alias("cpi")))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station-like table from shipments: TG/TN/TX in 0.1 units, RH, DR, SP."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(to_day("l_shipdate").alias("date"))
            .agg(F.sum("l_quantity").alias("TG"), (F.min("l_quantity") * 10).alias("TN"),
                 (F.max("l_quantity") * 10).alias("TX"), F.count(F.lit(1)).alias("RH"),
                 F.count_distinct("l_suppkey").alias("DR"), F.count_distinct("l_partkey").alias("SP")))
