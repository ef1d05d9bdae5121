import random
from datetime import date, timedelta
from statistics import mean, median

import pytest

from pricepanel.operators.windows import strided_windows

AGGS = {"s": ("sum", "x"), "lo": ("min", "x"), "hi": ("max", "x"), "n": ("count", "x"), "a": ("avg", "x"),
        "m": ("median", "x"), "u": ("count_distinct", "x")}


@pytest.mark.parametrize("every,period,after", [(7, 30, False), (7, 30, True), (1, 7, False), (10, 4, False), (5, 5, True)])
def test_same_as_brute_force(spark, every, period, after):
    rnd = random.Random(every)
    rows = [(rnd.choice(["a", "b", None]), date(2024, 1, 1) + timedelta(rnd.randrange(90)), rnd.choice([None, 1.0, 2.0, 5.5, 9.0]))
            for _ in range(200)] + [("a", None, 4.0)]
    out = strided_windows(spark.createDataFrame(rows, "k string, date date, x double"), every, period, AGGS, "k", after_last=after)
    got = {(r.k, r.date): tuple(r)[2:] for r in out.collect()}
    last, want = max(d for _, d, _ in rows if d), {}
    for j in range(-period, 200):
        e = last - timedelta(j * every)
        if e > last and not after:
            continue
        for k in ("a", "b", None):
            inside = [x for q, d, x in rows if q == k and d and e - timedelta(period) < d <= e]
            v = [x for x in inside if x is not None]
            if inside:
                want[k, e] = (sum(v) if v else None, min(v, default=None), max(v, default=None), len(v),
                              mean(v) if v else None, median(v) if v else None, len(set(v)))
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == pytest.approx(w)


def test_bad_settings(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1.0)], "k string, date date, x double")
    for args in ((0, 7, AGGS), (7, 7, {"z": ("mode", "x")})):
        with pytest.raises(ValueError):
            strided_windows(df, *args)
    assert strided_windows(df.limit(0), 7, 7, AGGS).count() == 0
