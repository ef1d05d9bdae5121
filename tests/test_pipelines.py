"""End-to-end plans on the smallest driver tables (entry A, C and B)."""

from pyspark.sql import functions as F

from pricepanel.operators import model as mdl
from pricepanel.plans import pipelines as pl
from pricepanel.schema import ClientProfile
from pricepanel.sources import io as pio
from pricepanel.sources import testdata as td


def test_entry_a_and_c(spark, sf_small):
    merged = pl.sales_with_competitors(td.brand_panel(spark, sf_small), td.competitor_prices(spark, sf_small),
                                       tiebreak=td.TIEBREAK)
    assert merged.count() == td.brand_panel(spark, sf_small).count()  # left join keeps every sales row
    assert "year_week" in merged.columns
    assert pl.receipt_panel(td.receipts(spark, sf_small)).count() >= 0


def test_entry_b_full_pipeline(spark, sf_small):
    profile = ClientProfile(name="demo", competitors=["africa", "america", "asia", "europe", "middle_east"],
                            status_vocabulary=["F", "O"], min_price_levels=2, min_sales=1.0, live_days=4000,
                            cpi_base_year=1998, constants={"client": "demo"})
    sales = pl.sales_with_competitors(td.brand_panel(spark, sf_small), td.competitor_prices(spark, sf_small),
                                      tiebreak=td.TIEBREAK)
    # brand group as the category ("Brand#1", "Brand#2", ...)
    sales = sales.withColumn("category_name_level1", F.substring("product_code", 1, 7))
    pre = pl.preprocess(sales, profile, td.monthly_index(spark, sf_small))
    featured = pl.build_features(pre, profile)
    result = pl.simulate_and_predict(featured, profile, mdl.ModelConfig(max_iter=5, max_depth=3), checkpoint=True)
    products, categories = pl.elasticities(result, pre, profile)
    assert result.estimations.count() > 0
    assert set(r.quality_tier for r in products.collect()) <= {"high", "medium", "low"}
    assert result.leakage.first().status in {"ok", "warning", "error"}
    assert categories.columns[-1] == "client"


def test_io_helpers(spark, sf_small, tmp_path):
    assert pio.artifact_path("s3://b/x", "price_grid", "weekly", None) == "s3://b/x/price_grid_weekly"
    path = str(tmp_path / "map.json")
    with open(path, "w") as fh:
        fh.write('{"Zuivel": "Dairy", "Brood": "Bread"}')
    m = {r.key: r.value for r in pio.load_json_mapping(spark, path).collect()}
    assert m == {"Zuivel": "Dairy", "Brood": "Bread"}
    nested = str(tmp_path / "cbs.json")
    with open(nested, "w") as fh:
        fh.write('{"value": [{"Perioden": "2020MM01", "CPI_1": 100.5}, {"Perioden": "2020JJ00", "CPI_1": 101.0}]}')
    assert pio.read_json_records(spark, nested).count() == 2
    assert pio.read_optional(spark, str(tmp_path / "missing")) is None
    df = td.daily_panel(spark, sf_small)
    out = str(tmp_path / "many")
    df.limit(10).write.parquet(out + "/a")
    df.limit(10).drop("n_lines").write.parquet(out + "/b")
    both = pio.read_many(spark, pio.list_files(spark, out), union_columns=True)
    assert both.count() == 20 and "n_lines" in both.columns
