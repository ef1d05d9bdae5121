"""Values stay what they are; NULLs, duplicates and hot keys have a defined result."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pricepanel.functions.prefix import exact_medians
from pricepanel.functions.scalars import fixed_point_sum, round_half_up
from pricepanel.operators import clean, competitors as comp, elasticity as el, model as mdl, panel, reference as ref, simulate as sim, weekly
from pricepanel.schema import RECEIPTS, ClientProfile, conform

D = dt.date


def test_rounding_neither_caps_nor_breaks(spark):
    values = [1e13, 1e20, -1e20, 9.3e12, -2.5, 2.5, 0.0, 1.005, -1234.565, float("inf"), None]
    got = [r.v for r in spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
           .orderBy("i").select(round_half_up("v", 6).alias("v")).collect()]
    assert got == [1e13, 1e20, -1e20, 9.3e12, -2.5, 2.5, 0.0, 1.005, -1234.565, float("inf"), None]
    whole = spark.createDataFrame([(2.5,), (-2.5,), (1e17,)], "v double").select(round_half_up("v", 0).alias("v")).collect()
    assert [r.v for r in whole] == [3.0, -3.0, 1e17]


def test_sums_keep_small_values_or_fail_openly(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "revenue_before double").withColumn("product_code", F.lit("p"))
    assert el.product_revenue(df).first().total_revenue == pytest.approx(0.012)
    assert df.agg(fixed_point_sum("revenue_before", 3).alias("s")).first().s == 0.012
    with pytest.raises(Exception, match="not a number with 2 decimals"):
        df.agg(fixed_point_sum("revenue_before", 2)).collect()


def test_exact_medians_with_ties_nulls_and_groups(spark):
    rnd = random.Random(1)
    rows = [("hot", float(rnd.randint(0, 5))) for _ in range(900)] + [("b", float(i)) for i in range(7)] + [("c", None), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r["median"] for r in exact_medians(df, "v", ["g"]).collect()}
    assert got == {g: statistics.median([v for h, v in rows if h == g and v is not None]) for g in ("hot", "b", None)}
    assert exact_medians(df, "v").first()["median"] == statistics.median([v for _, v in rows if v is not None])
    assert exact_medians(df.filter("false"), "v").first()["median"] is None


def test_first_n_without_tiebreak_uses_whole_days(spark):
    rows = [("p", "c", D(2024, 1, 1), float(v)) for v in range(9, 0, -1)] + [("p", "c", D(2024, 1, 2), 100.0), ("p", "c", None, 0.0)]
    df = spark.createDataFrame(rows, "product_code string, competitor_name string, price_date date, normalized_price double")
    out = comp.first_n_median(df, ["product_code", "competitor_name"], "price_date", "normalized_price", 5)
    assert out.first().baseline_median == 5.0
    flagged = comp.flag_price_outliers(df, min_observations=5)
    assert flagged.count() == 10  # the undated row takes no part


def test_rollup_on_its_own_schema(spark):
    rows = conform(spark.createDataFrame(
        [("p", 2, "20240101", 1.0, 9.0, 0.5, "A", "B1"), ("p", 1, "20240101", 2.0, 8.0, 0.25, None, "B2"),
         ("p", 1, "20240101", 5.0, 8.5, 7.0, "Z", "B3"), ("p", 1, "20240105", None, 8.0, None, "A", "B4")],
        "product_code string, store_code long, date_code string, quantity_sold double, product_selling_price double, "
        "revenue_before_discount_incl_vat double, product_status string, brand_name string"), RECEIPTS)
    out = {r.date: r for r in panel.product_day_rollup(rows).collect()}
    first = out[D(2024, 1, 1)]
    # the repeated (day, product, store) row counts once; values of the first store come from one row
    assert (first.quantity_sold, first.product_selling_price, first.product_status, first.brand_name) == (3.0, 8.0, None, "B2")
    assert (first.unique_stores_last_7_days, out[D(2024, 1, 5)].unique_stores_last_7_days) == (2, 2)
    assert out[D(2024, 1, 5)].quantity_sold == 0.0 and out[D(2024, 1, 5)].revenue_before_discount_incl_vat == 0.0
    assert len(panel.product_day_rollup(rows).columns) == 2 + 17


def test_names_come_from_one_row(spark):
    sales = spark.createDataFrame([("p",), ("q",)], "product_code string")
    names = spark.createDataFrame([("p", "A", "z"), ("p", "B", "y")], "product_code string, a string, b string")
    assert sorted(map(tuple, clean.merge_product_names(sales, names).collect())) == [("p", "A", "z"), ("q", None, None)]
    mapping = spark.createDataFrame([("p", "x"), ("p", "w")], "key string, value string")
    assert clean.map_values(sales, "product_code", mapping).count() == 2


def test_weeks_take_the_last_known_value_and_sum_nulls_to_zero(spark):
    df = spark.createDataFrame([("p", D(2024, 1, 1), 1.0, None), ("p", D(2024, 1, 2), None, None), ("p", D(2024, 1, 15), 2.0, 4.0)],
                               "product_code string, date date, product_selling_price double, quantity_sold double")
    out = [(r.product_selling_price, r.quantity_sold) for r in weekly.weekly_resample(df, fill=False).orderBy("week").collect()]
    assert out == [(1.0, 0.0), (None, 0.0), (2.0, 4.0)]
    assert mdl.last_actual_price(df.filter("date < '2024-01-10'"), "product_selling_price").first().product_selling_price == 1.0


def test_categories_without_a_name_are_none(spark):
    e = spark.createDataFrame([("p", -1.0), ("q", -2.0)], "product_code string, elasticity double")
    rows = spark.createDataFrame([("p", "c", 1.0), ("p", None, 9.0), ("q", None, 1.0)],
                                 "product_code string, category string, revenue_before double")
    out = el.category_elasticity(e, rows, "category", min_products=1).collect()
    assert [(r.category, r.num_products, r.elasticity_weighted) for r in out] == [("c", 1, -1.0)]


def test_joins_on_the_day_never_fan_out(spark):
    df = spark.createDataFrame([("p", D(2024, 1, 1), 2.0)], "product_code string, date date, product_selling_price double")
    two = spark.createDataFrame([(D(2024, 1, 1), 3.0, "a"), (D(2024, 1, 1), 1.0, "b")], "date date, mean_temp double, station string")
    assert [(r.mean_temp, r.station) for r in ref.add_weather(df, two).collect()] == [(1.0, "b")]


def test_simulated_rows_keep_no_real_price(spark):
    df = spark.createDataFrame([("p", D(2024, 1, i + 1), 10.0 + i, 20.0 + 2 * i, 9.0, 18.0) for i in range(3)],
                               "product_code string, date date, product_selling_price double, adjusted_price double, "
                               "product_selling_price_lag_1 double, adjusted_price_lag_1 double")
    out = sim.expand_counterfactual(df, lag_cols={1: ["product_selling_price_lag_1", "adjusted_price_lag_1"]},
                                    scaled_cols=["adjusted_price"])
    assert out.count() == 63
    for r in out.collect():
        assert r.adjusted_price == pytest.approx(2 * r.product_selling_price)
        lag = (9.0, 18.0) if r.sequence_number == 0 else (r.product_selling_price, r.adjusted_price)
        assert (r.product_selling_price_lag_1, r.adjusted_price_lag_1) == pytest.approx(lag)


def test_no_filter_or_cutoff_by_default(spark):
    profile = ClientProfile(name="x")
    assert (profile.min_sales, profile.live_days, profile.min_price_levels) == (None, None, None)
    rows = spark.createDataFrame([("p", "20990101", 1.0, 2.0)], "product_code string, date_code string, quantity_sold double, "
                                                                "product_selling_price double")
    assert panel.select_rows(rows).count() == 1 and panel.select_rows(rows, "2024-08-01").count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from pricepanel import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_unseen_and_null_levels_are_predicted(spark):
    rows = [("ab"[i % 2], D(2024, 1, 1) + dt.timedelta(days=i), 5.0 + (i % 2) * 10, 1.0 + i % 3) for i in range(80)]
    schema = "product_code string, date date, quantity_sold double, product_selling_price double"
    cfg = mdl.ModelConfig(max_iter=3, max_depth=2)
    df = spark.createDataFrame(rows, schema)
    model = mdl.train_demand_model(df, cfg, mdl.feature_columns(df, cfg))
    new = spark.createDataFrame([("a", D(2025, 1, 1), 0.0, 1.0), ("zz", D(2025, 1, 1), 0.0, 1.0), (None, D(2025, 1, 1), 0.0, None)], schema)
    got = mdl.predict_quantity(model, new).collect()
    assert len(got) == 3 and all(r.predicted_quantity >= 0 for r in got)
    # a row's own label is not in its training encoding
    data, encoded = mdl.encode_training(df, cfg, mdl.feature_columns(df, cfg))
    assert data.select("_e_product_code").distinct().count() > encoded.encodings.count()


def test_fixed_point_sum_of_small_and_large_values(spark):
    """Whole units and decimals add up to the exact sum; far values keep the decimal rule."""
    import random
    from decimal import Decimal
    random.seed(3)
    vals = [random.randint(-10 ** 9, 10 ** 9) / 100 for _ in range(2000)] + [123456789012.34, -98765432109.87, 0.0, 1e8, 99999999.99]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    assert df.agg(fixed_point_sum("v", 2).alias("s")).first().s == float(sum(Decimal(str(v)) for v in vals))
    assert df.filter("v is null").agg(fixed_point_sum("v", 2).alias("s")).first().s is None
    with pytest.raises(Exception, match="not a number with 2 decimals"):
        spark.createDataFrame([(0.010005,)], "v double").agg(fixed_point_sum("v", 2)).collect()
