"""Settings that switch parts of the plans off or replace them."""
from datetime import date

from pyspark.sql import functions as F

from pricepanel.operators import calendar as cal, clean, reference as ref
from pricepanel.plans import pipelines as pl
from pricepanel.schema import ClientProfile


def sales(spark):
    return spark.createDataFrame(
        [("p1", date(2024, 1, d), 10.0 + d, 1.23456, "Active" if d % 2 else "Gone") for d in range(1, 21)],
        "product_code string, date date, quantity_sold double, product_selling_price double, product_status string")


def test_status_filter_can_be_off(spark):
    assert clean.filter_status(sales(spark), None).count() == 20
    assert pl.preprocess(sales(spark), ClientProfile("x", status_vocabulary=None)).count() == 20
    assert pl.preprocess(sales(spark), ClientProfile("x")).count() == 10


def test_rounding_and_grid_at_the_end(spark):
    profile = ClientProfile("x", status_vocabulary=None, round_digits=2, grid_days=3)
    rows, grid = pl.preprocess_with_grid(sales(spark), profile)
    assert {r.product_selling_price for r in rows.collect()} == {1.23}
    got = grid.collect()
    assert sorted(r.date.day for r in got) == [18, 19, 20] and all(min(r.prices) < 1.23 < max(r.prices) for r in got)


def test_own_holidays(spark):
    own = spark.createDataFrame([(date(2024, 1, 5), "B day"), (date(2024, 1, 5), "A day"), (date(2024, 1, 9), None)],
                                "date date, holiday string")
    out = {r.date.day: r for r in cal.add_holiday_features(sales(spark), holidays=own).collect()}
    assert out[5].holiday == "A day; B day" and out[1].holiday == "No holiday" and out[1].time_until_next_holiday == 4
    assert out[9].time_after_previous_holiday == 4
    feats = pl.build_features(sales(spark), ClientProfile("x"), holidays=own)
    assert feats.filter(F.col("holiday").contains("A day")).count() == 1


def test_carrying_the_index_to_a_day_before_its_end(spark):
    monthly = spark.createDataFrame([(date(2024, m, 1), 100.0 + m) for m in range(1, 7)], "month_year date, cpi double")
    assert ref.carry_cpi_forward(monthly, "2024-02-10").count() == 6
    assert ref.carry_cpi_forward(monthly, "2024-06-10").count() == 7
