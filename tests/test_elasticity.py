import pytest

from pricepanel.functions.scalars import price_ladder, round_half_up
from pricepanel.operators import elasticity as el


def est(spark, rows):
    return spark.createDataFrame(rows, "product_code string, p double, q double")


def test_power_law_recovers_slope_and_closed_form_arc(spark):
    b = -1.7
    prices = [8.0, 9.0, 10.0, 11.0, 12.0]
    rows = [("a", p, 50.0 * p ** b) for p in prices]
    df = est(spark, rows)
    fits = el.fit_demand_curves(df, "p", "q")
    f = fits.collect()[0]
    assert f.slope == pytest.approx(b) and f.r2 == pytest.approx(1.0)
    e = el.arc_elasticity(el.demand_curve(df, fits, "p")).collect()[0].elasticity
    assert e == pytest.approx(el.closed_form_arc(b, 9.0, 11.0))


def test_curve_edge_cases(spark):
    rows = [("const_p", 5.0, 1.0), ("const_p", 5.0, 2.0),
            ("const_q", 1.0, 3.0), ("const_q", 2.0, 3.0), ("const_q", 3.0, 3.0),
            ("two", 1.0, 2.0), ("two", 2.0, 1.0),
            ("one", 1.0, 1.0)]
    df = est(spark, rows)
    fits = {r.product_code: r for r in el.fit_demand_curves(df, "p", "q").collect()}
    assert "const_p" not in fits and "one" not in fits
    assert fits["const_q"].slope == 0.0 and fits["const_q"].r2 == 1.0
    e = {r.product_code for r in el.arc_elasticity(el.demand_curve(df, el.fit_demand_curves(df, "p", "q"), "p")).collect()}
    # two points -> no middle elasticity; constant quantity -> elasticity 0 -> dropped
    assert e == set()


def test_quality_tier_boundaries(spark):
    e = spark.createDataFrame([(k, -1.0) for k in "abcdef"], "product_code string, elasticity double")
    fits = spark.createDataFrame([("a", 0.95), ("b", 0.80), ("c", 0.95), ("d", 0.95), ("e", 0.79)],
                                 "product_code string, r2 double")
    std = spark.createDataFrame([("c", 0.10), ("d", 0.20), ("b", 0.20)], "product_code string, day_std double")
    t = {r.product_code: r.quality_tier for r in el.quality_tiers(e, fits, std).collect()}
    assert t == {"a": "high", "b": "medium", "c": "high", "d": "medium", "e": "low", "f": "low"}


def test_summary_open_intervals(spark):
    e = spark.createDataFrame([("a", -5.0), ("b", -1.0), ("c", 0.0), ("d", -2.0), ("e", -0.5), ("f", 1.0),
                               ("g", -6.0)], "product_code string, elasticity double")
    s = el.elasticity_summary(e).collect()[0]
    assert (s.elastic_count, s.inelastic_count, s.positive_count, s.outlier_count) == (1, 1, 1, 1)
    assert s.total_products == 7


def test_price_ladder_21_points(spark):
    df = spark.createDataFrame([(10.0,)], "p double")
    ladder = df.select(price_ladder("p", -10, 10).alias("l")).collect()[0].l
    assert len(ladder) == 21 and ladder[0] == 9.0 and ladder[10] == 10.0 and ladder[-1] == 11.0


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    assert [r.y for r in df.select(round_half_up("x", 2).alias("y")).collect()][:2] == [0.13, -0.13]


def test_day_slope_dispersion_needs_two_slopes(spark):
    rows = [("a", 1, 1.0, 10.0), ("a", 1, 2.0, 5.0), ("a", 2, 1.0, 10.0), ("a", 2, 2.0, 2.5),
            ("b", 1, 1.0, 10.0), ("b", 1, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "product_code string, day int, p double, q double")
    out = {r.product_code: r.day_std for r in el.slope_dispersion(df, "p", "q", "day").collect()}
    assert out["b"] is None and out["a"] == pytest.approx(0.5)
