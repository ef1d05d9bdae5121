import datetime as dt

from pricepanel.operators import clean, panel, weekly

D = dt.date


def test_pearson_constant_side_is_null_not_error(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, 5.0), ("b", 2.0, 5.0),
                                ("c", 1.0, 1.0)], "k string, x double, y double")
    out = {r.k: r.c for r in df.groupBy("k").agg(panel.pearson(F.col("x"), F.col("y")).alias("c")).collect()}
    assert abs(out["a"] - 1.0) < 1e-12 and out["b"] is None and out["c"] is None


def test_rolling_unique_stores_window_edges(spark):
    rows = [("p", 1, D(2024, 1, 1)), ("p", 1, D(2024, 1, 3)), ("p", 2, D(2024, 1, 8)), ("p", 3, D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "product_code string, store_code long, date date")
    got = {r.date: r.unique_stores_last_7_days for r in panel.rolling_unique_stores(df, 7).collect()}
    # on Jan 8 the window is (Jan 1, Jan 8]: store 3 (Jan 1, exactly 7 days back) is out, store 1 (Jan 3) in
    assert got == {D(2024, 1, 1): 2, D(2024, 1, 3): 2, D(2024, 1, 8): 2}


def test_zero_runs_of_seven_removed(spark):
    qty = [1.0] + [0.0] * 6 + [2.0] + [None] * 7 + [3.0] + [0.0] * 8
    rows = [("p", D(2024, 1, 1) + dt.timedelta(days=i), q) for i, q in enumerate(qty)]
    df = spark.createDataFrame(rows, "product_code string, date date, quantity_sold double")
    out = clean.remove_zero_runs(df, 7).orderBy("date").collect()
    # the run of 6 zeros stays (as 0), the runs of 7 NULLs and 8 zeros go
    assert [r.quantity_sold for r in out] == [1.0] + [0.0] * 6 + [2.0, 3.0]


def test_bounded_ffill(spark):
    vals = [None, 1.0, None, 2.0, None, None, 3.0, None, None, None, 4.0]
    rows = [("p", D(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "product_code string, date date, price double")
    out = [r.price for r in clean.bounded_ffill(df, "price", 2).orderBy("date").collect()]
    assert out == [None, 1.0, 1.0, 2.0, 2.0, 2.0, 3.0, None, None, None, 4.0]


def test_iqr_fence_uses_multiplier_two_and_floor_zero(spark):
    prices = [10.0, 11.0, 12.0, 13.0, 14.0, 100.0, 0.5]
    rows = [("p", D(2024, 1, i + 1), p) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "product_code string, date date, product_selling_price double")
    kept = sorted(r.product_selling_price for r in clean.filter_iqr(df).collect())
    assert 100.0 not in kept and 10.0 in kept


def test_weekly_resample_gap_week_and_iso_boundary(spark):
    rows = [("p", D(2021, 1, 3), 5.0, 1.0),   # Sunday, ISO week 2020_53, Monday bin 2020-12-28
            ("p", D(2021, 1, 4), 6.0, 2.0),   # Monday
            ("p", D(2021, 1, 19), 7.0, 3.0)]  # skips the week of 2021-01-11
    df = spark.createDataFrame(rows, "product_code string, date date, product_selling_price double, quantity_sold double")
    out = weekly.weekly_resample(df).orderBy("week").collect()
    assert [r.week for r in out] == [D(2020, 12, 28), D(2021, 1, 4), D(2021, 1, 11), D(2021, 1, 18)]
    assert [r.quantity_sold for r in out] == [1.0, 2.0, 0.0, 3.0]
    assert [r.product_selling_price for r in out] == [5.0, 6.0, 6.0, 7.0]
    iso = weekly.weekly_iso(df).orderBy("year_week").collect()
    assert iso[0].year_week == "2020_53"


def test_rename_and_dedupe_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "promo_ind int, a int, b int").toDF("promo_ind", "a", "a")
    out = clean.deduplicate_column_names(clean.rename_columns(df))
    assert out.columns == ["promotion_indicator", "a", "a_2"]
