import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pricepanel.operators import boosting as B
from pricepanel.operators import model as M


@pytest.fixture(scope="module")
def rows(spark):
    """Compound Poisson-gamma targets: many zeros, a mean that depends on two features."""
    rng = np.random.default_rng(0)
    out = []
    for i in range(1500):
        a, b = rng.uniform(0, 3), rng.integers(0, 4)
        mean = math.exp(0.9 * a - 0.7 * b)
        n = rng.poisson(mean / 2)
        out.append((float(a), float(b), float(rng.gamma(2, 1, n).sum()), i % 4 == 0))
    df = spark.createDataFrame(out, "a double, b double, y double, test boolean").withColumns(
        {"_label": F.col("y"), "_weight": F.lit(1.0)})
    return VectorAssembler(inputCols=["a", "b"], outputCol="_features").transform(df).cache()


def deviance(df, mean):
    return B.tweedie_deviance(df, "y", mean, 1.24).first()["deviance"]


def test_deviance_and_leaf_steps_by_hand(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0), (2.0, 1.5, 0), (3.0, 0.5, 1), (None, 1.0, 1), (1.0, None, 1)],
                               "y double, mu double, leaf int")
    p = 1.24

    def unit(y, m):
        return 2 * (y ** (2 - p) / ((1 - p) * (2 - p)) - y * m ** (1 - p) / (1 - p) + m ** (2 - p) / (2 - p))

    got = B.tweedie_deviance(df, "y", "mu", p).first()
    assert got.n_rows == 3 and got.deviance == pytest.approx(np.mean([unit(0, 1), unit(2, 1.5), unit(3, .5)]))
    assert unit(2, 2) == pytest.approx(0)
    f = F.log("mu")
    used = df.filter("y is not null and mu is not null")
    steps = {r.leaf: r for r in B.newton_leaf_values(used, "leaf", B.tweedie_gradient(F.col("y"), f, p),
                                                     B.tweedie_hessian(F.col("y"), f, p), 0.5).collect()}
    for leaf, pts in ((0, [(0, 1), (2, 1.5)]), (1, [(3, .5)])):
        g = sum(-y * m ** (1 - p) + m ** (2 - p) for y, m in pts)
        h = sum((p - 1) * y * m ** (1 - p) + (2 - p) * m ** (2 - p) for y, m in pts)
        assert steps[leaf].step == pytest.approx(-g / (h + 0.5))


def test_beats_the_mean_and_squared_error_on_held_out_rows(spark, rows):
    train, test = rows.filter("not test"), rows.filter("test")
    model = B.fit_tweedie(train, 12, step_size=0.3, max_depth=3, write_every=5)
    got = deviance(model.transform(test).withColumnRenamed("prediction", "mu"), "mu")
    mean = train.agg(F.avg("y")).first()[0]
    assert got < 0.8 * deviance(test.withColumn("mu", F.lit(mean)), "mu")
    enc = M.DemandModel(None, ["a", "b"], [], ["a", "b"], None, 0, 0.0, M.ModelConfig())
    cfg = M.ModelConfig(max_iter=12, step_size=0.3, max_depth=3)
    squared = M.fit_trees(train.select("a", "b", "_label", "_weight"), enc, cfg)
    other = squared.trees.transform(test).withColumn("mu", F.greatest("prediction", F.lit(1e-6)))
    assert got < deviance(other, "mu")
    same = M.fit_trees(train.select("a", "b", "_label", "_weight"), enc, replace(cfg, loss="tweedie"))
    assert isinstance(same.trees, B.TweedieTrees) and sum(same.trees.featureImportances.toArray()) == pytest.approx(1)


def test_going_on_equals_one_run_and_survives_saving(spark, rows, tmp_path):
    train = rows.filter("not test")
    whole = B.fit_tweedie(train, 4, step_size=0.3, max_depth=2, write_every=2)
    half = B.fit_tweedie(train, 2, step_size=0.3, max_depth=2)
    more = B.fit_tweedie(train, 2, step_size=0.3, max_depth=2, start=half)
    assert len(half.trees) == 2 and len(more.trees) == 4
    want = [r[0] for r in whole.transform(rows).select("prediction").collect()]
    assert [r[0] for r in more.transform(rows).select("prediction").collect()] == pytest.approx(want)
    whole.save(f"file://{tmp_path}/m")
    back = B.TweedieTrees.load(spark, f"file://{tmp_path}/m")
    assert [r[0] for r in back.transform(rows).select("prediction").collect()] == pytest.approx(want)


def test_no_positive_label(spark, rows):
    model = B.fit_tweedie(rows.withColumn("_label", F.lit(0.0)), 3)
    assert not model.trees and model.transform(rows).agg(F.max("prediction")).first()[0] < 1e-300
    with pytest.raises(ValueError):
        B.fit_tweedie(rows, 1, power=2.0)


def test_halving_ranks_like_the_plain_loop(spark):
    rng = np.random.default_rng(1)
    data = [(str(i % 5), f"2024-01-{1 + i % 28:02d}", float(p := rng.uniform(1, 5)), float(100 / p + rng.normal(0, 2)))
            for i in range(400)]
    df = spark.createDataFrame(data, "product_code string, date string, product_selling_price double, quantity_sold double") \
        .withColumn("date", F.to_date("date"))
    cfg = M.ModelConfig(max_iter=2, max_depth=2)
    feats = ["product_code", "product_selling_price"]
    grid = [dict(max_depth=d, step_size=s) for d in (1, 3) for s in (0.05, 0.9)]
    one = {r.param_set: r for r in M.successive_halving(df, cfg, feats, grid, 2, 2, 2).collect()}
    plain = {r.param_set: r.rmse for r in M.time_series_cv(df, cfg, feats, grid, 2).collect()}
    assert {i: r.rmse for i, r in one.items()} == pytest.approx(plain)
    assert sorted(one, key=lambda i: one[i].rank) == sorted(plain, key=lambda i: (plain[i], i))
    two = {r.param_set: r for r in M.successive_halving(df, cfg, feats, grid, 2, 2, 4, parallel=3).collect()}
    best = sorted(plain, key=lambda i: (plain[i], i))[:2]
    assert {i for i, r in two.items() if r.trees == 4} == set(best)
    full = {r.param_set: r.rmse for r in M.time_series_cv(df, replace(cfg, max_iter=4), feats, grid, 2).collect()}
    assert {i: two[i].rmse for i in best} == pytest.approx({i: full[i] for i in best})
    assert sorted(r.rank for r in two.values()) == [1, 2, 3, 4]
    assert min(best, key=lambda i: (full[i], i)) == min(two, key=lambda i: two[i].rank)
