"""Canonical table schemas and the client profile (what a retailer adapter configures)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, LongType, StringType,
                               StructField, StructType)

SALES = StructType([
    StructField("product_code", StringType(), False),
    StructField("date", DateType(), False),
    StructField("quantity_sold", DoubleType()),
    StructField("product_selling_price", DoubleType()),
    StructField("revenue_before", DoubleType()),
    StructField("revenue_after", DoubleType()),
    StructField("promotion_indicator", BooleanType()),
    StructField("product_status", StringType()),
    StructField("category_name_level1", StringType()),
    StructField("category_name_level2", StringType()),
    StructField("category_name_level3", StringType()),
    StructField("brand_name", StringType()),
])

COMPETITOR_PRICES = StructType([
    StructField("product_code", StringType(), False),
    StructField("competitor_name", StringType(), False),
    StructField("price_date", DateType(), False),
    StructField("normalized_price", DoubleType()),
])

RECEIPTS = StructType([
    StructField("product_code", StringType(), False),
    StructField("store_code", LongType()),
    StructField("date_code", StringType()),
    StructField("quantity_sold", DoubleType()),
    StructField("weight_sold", DoubleType()),
    StructField("product_selling_price", DoubleType()),
    StructField("calculated_price", DoubleType()),
    StructField("calculated_price_after_discount", DoubleType()),
    StructField("revenue_before_discount_incl_vat", DoubleType()),
    StructField("promo_ind", BooleanType()),
    StructField("product_status", StringType()),
    StructField("product_category_code_level1", StringType()),
    StructField("product_category_code_level2", StringType()),
    StructField("product_category_code_level3", StringType()),
    StructField("ah_price", DoubleType()),
    StructField("ah_content_factor", DoubleType()),
    StructField("plus_price", DoubleType()),
    StructField("plus_content_factor", DoubleType()),
    StructField("brand_name", StringType()),
])

PRICE_GRID = StructType([
    StructField("product_code", StringType(), False),
    StructField("date", DateType(), False),
    StructField("sequence_number", LongType()),
    StructField("prices", ArrayType(DoubleType())),
])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones are NULL, others stay behind them."""
    own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
           else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*own, *[c for c in df.columns if c not in schema.names])


@dataclass
class ClientProfile:
    """Everything that differs between retailers: names, competitors, vocabularies, constants.

    A filter whose setting is None is not applied.
    """
    name: str
    competitors: list[str] = field(default_factory=list)
    category_column: str = "category_name_level1"
    status_vocabulary: list[str] | None = field(default_factory=lambda: ["Active"])
    channel: str | None = None
    drop_columns: list[str] = field(default_factory=list)
    constants: dict[str, str] = field(default_factory=dict)
    price_column: str = "product_selling_price"
    target: str = "quantity_sold"
    price_change_columns: list[str] = field(default_factory=lambda: ["product_selling_price"])
    store_columns: list[str] = field(default_factory=list)          # forward-filled per product
    artifact_overrides: dict[str, str] = field(default_factory=dict)
    min_price_levels: int | None = None
    min_sales: float | None = None
    live_days: int | None = None
    max_competitor_null_pct: float | None = None
    round_digits: int | None = None
    min_category_products: int = 5
    cpi_base_year: int = 2023
    price_lags: list[int] = field(default_factory=lambda: [1, 7, 14])
    grid_days: int = 14
    min_grid_pct: int = -10
    max_grid_pct: int = 10
    test_end_date: str | None = None
    min_tier: str = "low"
