import datetime as dt

import pytest

from pricepanel.operators import competitors as comp

D = dt.date


def frame(spark, rows):
    return spark.createDataFrame(rows, "product_code string, competitor_name string, price_date date, "
                                       "normalized_price double, l_orderkey long, l_linenumber int")


def test_outlier_filter_drops_high_and_low(spark):
    # 8 prices for one key with one 100x and one 0.01x value
    prices = [10.0, 10.5, 9.5, 1000.0, 10.2, 0.1, 9.8, 10.1]
    rows = [("p", "c", D(2024, 1, 1) + dt.timedelta(days=i), p, i, 1) for i, p in enumerate(prices)]
    out = comp.filter_price_outliers(frame(spark, rows), tiebreak=["l_orderkey", "l_linenumber"])
    kept = sorted(r.normalized_price for r in out.collect())
    assert 1000.0 not in kept and 0.1 not in kept
    assert len(kept) == 6


def test_null_price_dropped_and_short_key_uses_first_n(spark):
    rows = [("p", "c", D(2024, 1, 1), 10.0, 1, 1), ("p", "c", D(2024, 1, 2), None, 2, 1),
            ("p", "c", D(2024, 1, 3), 50.0, 3, 1)]
    out = comp.filter_price_outliers(frame(spark, rows), tiebreak=["l_orderkey", "l_linenumber"])
    # fewer than 5 observations: baseline = median(10, 50) = 30; 50 <= 60 and 10 >= 9 -> both kept
    assert sorted(r.normalized_price for r in out.collect()) == [10.0, 50.0]


def test_rolling_window_excludes_day_180_back_and_includes_peers(spark):
    base = D(2024, 1, 1)
    rows = [("p", "c", base, 100.0, 1, 1),
            ("p", "c", base + dt.timedelta(days=180), 1.0, 2, 1),   # day 180 back is outside (t-180, t]
            ("p", "c", base + dt.timedelta(days=180), 3.0, 3, 1)]   # same-day peer is inside
    out = comp.rolling_median(frame(spark, rows), ["product_code", "competitor_name"], "price_date",
                              "normalized_price", 180)
    got = {(r.l_orderkey): (r.rolling_median, r.rolling_count) for r in out.collect()}
    assert got[1] == (100.0, 1)
    assert got[2] == (2.0, 2) and got[3] == (2.0, 2)


def test_rolling_median_matches_brute_force_across_buckets(spark):
    import random
    rnd = random.Random(7)
    base = D(2020, 1, 1)
    rows = [("p", "c", base + dt.timedelta(days=rnd.randrange(900)), float(rnd.randrange(1, 100)), i, 1)
            for i in range(300)]
    out = comp.rolling_median(frame(spark, rows), ["product_code", "competitor_name"], "price_date",
                              "normalized_price", 180)
    import statistics
    got = {r.l_orderkey: r.rolling_median for r in out.collect()}
    for (_, _, d, _, k, _) in rows:
        window = [p for (_, _, d2, p, _, _) in rows if d - dt.timedelta(days=180) < d2 <= d]
        assert got[k] == pytest.approx(statistics.median(window))


def test_first_n_median_counts_observations_not_rows(spark):
    rows = [("p", "c", D(2024, 1, i + 1), None if v is None else float(v), i, 1)
            for i, v in enumerate([None, 1, 2, 3, 4, 5, 100])]
    out = comp.first_n_median(frame(spark, rows), ["product_code", "competitor_name"], "price_date",
                              "normalized_price", 5, ["l_orderkey"]).collect()
    assert out[0].baseline_median == 3.0


def test_pivot_slug_and_merge(spark):
    long = frame(spark, [("p", "MIDDLE EAST", D(2024, 1, 1), 2.0, 1, 1), ("p", "Asia", D(2024, 1, 1), 4.0, 2, 1),
                         ("p", "Asia", D(2024, 1, 1), 6.0, 3, 1)])
    wide = comp.pivot_competitors(comp.median_dedupe(long), ["Asia", "MIDDLE EAST"])
    assert wide.columns == ["product_code", "price_date", "asia_price", "middle_east_price"]
    r = wide.collect()[0]
    assert (r.asia_price, r.middle_east_price) == (5.0, 2.0)
    sales = spark.createDataFrame([("p", D(2024, 1, 1), 3.0), ("p", D(2024, 1, 2), 1.0)],
                                  "product_code string, date date, quantity_sold double")
    merged = comp.merge_sales_competitors(sales, wide).orderBy("date").collect()
    assert len(merged) == 2 and merged[1].asia_price is None and merged[0].year_week == "2024_01"


def test_sparse_competitor_dropped(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 1.0)], "a_price double, b_price double")
    assert comp.drop_sparse_competitors(df, ["a", "b"]).columns == ["a_price"]


def test_rolling_median_methods_agree_with_peers_and_many_buckets(spark):
    import random
    rnd = random.Random(11)
    base = D(2019, 6, 1)
    rows = []
    for i in range(400):
        key = "hot" if i % 4 else "cold"
        rows.append((key, "c", base + dt.timedelta(days=rnd.randrange(0, 1200, 3)), float(rnd.randrange(1, 60)), i, 1))
    df = frame(spark, rows)
    args = (["product_code", "competitor_name"], "price_date", "normalized_price", 180)
    a = {r.l_orderkey: (r.rolling_median, r.rolling_count)
         for r in comp.rolling_median(df, *args, method="window").collect()}
    b = {r.l_orderkey: (r.rolling_median, r.rolling_count)
         for r in comp.rolling_median(df, *args, method="stream").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][1] == b[k][1] and a[k][0] == pytest.approx(b[k][0])
