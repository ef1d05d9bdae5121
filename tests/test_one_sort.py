"""Runs, fills and price runs sort a product's rows once; product panels are shuffled once, into tasks of a fixed size."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from pricepanel.operators import clean, model, weekly
from pricepanel.operators import elasticity as el
from pricepanel.operators import features as feat
from pricepanel.sources import testdata as td


def plan(df, mode="simple"):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node):
    return len(re.findall(rf"[-+:] {node} ", plan(df)))


@pytest.fixture
def folder(spark, tmp_path):
    """120 line items of 4 parts."""
    rows = [(i, i % 7 + 1, i % 4, 1, dt.date(2024, 1, 1) + dt.timedelta(days=3 * (i // 4)), 2.0, 10.0 + 2 * (i % 5), 0.1, "F", "N")
            for i in range(120)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_quantity double,"
                          " l_extendedprice double, l_discount double, l_linestatus string, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(td, "TASK_ROWS", 2, raising=False)  # 120 lines: 60 tasks


def values(spark, given):
    rows = [("p", dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(given)]
    return spark.createDataFrame(rows, "product_code string, date date, v double")


@pytest.mark.parametrize("given, filled", [
    ([None, 1.0, None, None, 2.0, None, None, None, 3.0, None], [None, 1.0, 1.0, 1.0, 2.0, None, None, None, 3.0, 3.0]),
    ([1.0, None, None], [1.0, 1.0, 1.0]), ([1.0, None, None, None], [1.0, None, None, None]), ([None, None], [None, None])])
def test_fill_one_sort(spark, given, filled):
    out = clean.bounded_ffill(values(spark, given), "v", 2)
    assert [r.v for r in out.orderBy("date").collect()] == filled
    assert count(out, "Sort") == 1


@pytest.mark.parametrize("given, left", [
    ([0.0, None, 0.0, 5.0, 0.0, 0.0, 6.0], [5.0, 0.0, 0.0, 6.0]), ([1.0, 0.0, 0.0, 0.0], [1.0]), ([1.0, 0.0, None], [1.0, 0.0, 0.0]),
    ([0.0] * 9, []), ([1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0], [1.0, 2.0])])
def test_zero_runs_one_sort(spark, given, left):
    out = clean.remove_zero_runs(values(spark, given), 3, qty_col="v")
    assert [r.v for r in out.orderBy("date").collect()] == left
    assert count(out, "Sort") == 1


def test_price_runs_one_sort(spark):
    out = feat.add_price_runs(values(spark, [2.0, 2.0, 3.0, 3.0, None, 3.0, 4.0, 4.0, 4.0]), "v")
    got = [(r.price_change, r.price_change_group, r.days_since_last_change) for r in out.orderBy("date").collect()]
    assert got == [(False, 0, 0), (False, 0, 1), (True, 1, 0), (False, 1, 1), (False, 1, 2), (False, 1, 3), (True, 2, 0),
                   (False, 2, 1), (False, 2, 2)]
    assert count(out, "Sort") == 1


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(.*?(\d+)\)", plan(df))


def test_weekly_fill_one_shuffle(spark, folder, small_tasks):
    """no shuffle by day, week and product one after another, and tasks that follow the table."""
    out = clean.bounded_ffill(weekly.weekly_resample(td.daily_panel(spark, folder), fill=False), "product_selling_price", 2, order_col="week")
    assert exchanges(out) == ["60"]
    assert out.count() == 4 * 13


def test_price_sums_without_shuffle(spark, folder, small_tasks):
    """simulated prices are summed where they arise."""
    panel = td.daily_panel(spark, folder)
    per_day = panel.select("product_code", F.explode(F.array("product_selling_price", F.lit(1.0))).alias("product_selling_price_calc"),
                           F.lit(1.0).alias("predicted_quantity"))
    out = model.estimations(per_day, panel)
    assert set(exchanges(out)) == {"60"} and len(exchanges(out)) <= 2


def test_weekly_change_and_curves_one_shuffle(spark, folder, small_tasks):
    """one shuffle, into tasks of a fixed size."""
    assert exchanges(weekly.weekly_days_since_change(feat.add_price_runs(td.daily_panel(spark, folder)))) == ["60"]
    est = td.daily_panel(spark, folder).withColumn("year", F.year("date")).groupBy("product_code", "year", "product_selling_price").agg(
        F.sum("quantity_sold").alias("q"))
    assert exchanges(el.fit_demand_curves(est, "product_selling_price", "q", ["product_code", "year"])) == ["60"]


def test_queries_spread_their_rows(spark, folder, small_tasks):
    """every shuffle of the query has tasks of a fixed size."""
    from pricepanel.plans.queries import QUERIES
    assert exchanges(QUERIES["tied_rows"](spark, folder)) == ["60"]
    assert count(QUERIES["tied_rows"](spark, folder), "Sort") == 1
    assert set(exchanges(QUERIES["demand_curve_sequences"](spark, folder))) == {"60"}


def test_sparse_drop_reads_written_rows(spark):
    """what made the rows does not run again after the shares are known."""
    from pricepanel.operators import competitors as comp
    rows = spark.createDataFrame([(1, 1.0, None), (1, 2.0, 3.0), (2, 4.0, None)], "k int, a_price double, b_price double")
    out = comp.drop_sparse_competitors(rows.groupBy("k").agg(F.max("a_price").alias("a_price"), F.max("b_price").alias("b_price")),
                                       ["a", "b"], 40.0)
    assert "Aggregate" not in plan(out) and "parquet" in plan(out)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.0), (2, 4.0)]


def test_brand_rows_join_whole_numbers(spark, folder):
    """F8, F10: line items and parts are joined by their numbers, as for the competitor prices."""
    spark.createDataFrame([(i, f"B{i % 2}") for i in range(4)], "p_partkey long, p_brand string").write.parquet(f"{folder}/part.parquet")
    out = td.brand_rows(spark, folder)
    assert not re.search(r"Join \[part_code", plan(out)) and "product_code" in out.columns and "l_partkey" not in out.columns
    assert {r.product_code: r.n for r in out.groupBy("product_code").agg(F.count("*").alias("n")).collect()} == {"B0": 60, "B1": 60}
