"""Gradient-boosted trees with Tweedie deviance (log link), as Spark ML trees and grouped Newton steps.

With score ``f`` and mean ``mu = exp(f)`` a row of target ``y >= 0`` has the loss
``-y mu^(1-p) / (1-p) + mu^(2-p) / (2-p)``, 1 < p < 2 the variance power.  A round fits one tree to the Newton
response ``-g / h`` with weight ``h`` (its split gain is then that of the second-order expansion), and gives each
leaf the step ``-G / (H + reg)`` from sums of gradients and hessians grouped by leaf: one row a leaf comes back,
however many rows there are.

Scores are carried as an expression over the trees since the rows were last written; every ``write_every`` rounds the
rows are written anew with their score, so neither plan nor recomputation grows with the number of trees, and a
lost executor replays few rounds.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage


def tweedie_gradient(y, score, power: float):
    """First derivative of the loss by the score."""
    return -y * F.exp((1 - power) * score) + F.exp((2 - power) * score)


def tweedie_hessian(y, score, power: float):
    """Second derivative of the loss by the score; above zero for 1 < power < 2."""
    return (power - 1) * y * F.exp((1 - power) * score) + (2 - power) * F.exp((2 - power) * score)


def tweedie_deviance(df: DataFrame, target: str, mean: str, power: float, weight: str | None = None) -> DataFrame:
    """One row: the (weighted) mean unit deviance of predicted means above zero; NULLs are left out."""
    y, mu = F.col(target).cast("double"), F.col(mean)
    unit = 2 * (F.pow(y, F.lit(2 - power)) / ((1 - power) * (2 - power))
                - y * F.pow(mu, F.lit(1 - power)) / (1 - power) + F.pow(mu, F.lit(2 - power)) / (2 - power))
    w = F.lit(1.0) if weight is None else F.col(weight)
    used = df.filter(y.isNotNull() & (mu > 0))
    return used.agg(F.try_divide(F.sum(unit * w), F.sum(w)).alias("deviance"), F.count(F.lit(1)).alias("n_rows"))


def newton_leaf_values(df: DataFrame, leaf: str, gradient, hessian, reg: float = 1.0, weight=None) -> DataFrame:
    """One row a leaf: sums of gradients and hessians and the step ``-G / (H + reg)``."""
    w = F.lit(1.0) if weight is None else weight
    return df.groupBy(leaf).agg(F.sum(gradient * w).alias("gradient"), F.sum(hessian * w).alias("hessian")).withColumn(
        "step", -F.col("gradient") / (F.col("hessian") + F.lit(float(reg))))


@dataclass
class TweedieTrees:
    """Trees, their leaves' steps (already times the learning rate) and the score all rows start from."""

    base: float
    power: float
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    steps: list[list[float]] = field(default_factory=list)

    def score(self, df: DataFrame, start: int = 0, from_col: str | None = None, out_col: str = "_score") -> DataFrame:
        """``df`` with the score of the trees from ``start`` on, added to ``from_col`` (default: the base)."""
        total = F.lit(self.base) if from_col is None else F.col(from_col)
        leaf_cols = []
        for k in range(start, len(self.trees)):
            leaf = f"__leaf_{k}"
            tree = self.trees[k].setPredictionCol(f"__tree_{k}").setLeafCol(leaf)
            df = tree.transform(df)
            total = total + F.element_at(F.array(*[F.lit(s) for s in self.steps[k]]), F.col(leaf).cast("int") + 1)
            leaf_cols += [f"__tree_{k}", leaf]
        return df.withColumn(out_col, total).drop(*leaf_cols)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``_features``) and ``prediction``, the predicted mean."""
        return self.score(df, out_col="__score").withColumn("prediction", F.exp("__score")).drop("__score")

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  as Spark's tree ensembles name it
        """Mean of the trees' importances, adding up to 1."""
        total = sum((t.featureImportances.toArray() for t in self.trees))
        return Vectors.dense(total / max(total.sum(), 1e-300))

    def save(self, path: str) -> None:
        for k, t in enumerate(self.trees):
            t.write().overwrite().save(f"{path}/tree-{k}")
        spark = SparkSession.getActiveSession()
        text = json.dumps({"base": self.base, "power": self.power, "steps": self.steps})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/steps")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TweedieTrees:
        s = json.loads(spark.read.text(f"{path}/steps").first()[0])
        trees = [DecisionTreeRegressionModel.load(f"{path}/tree-{k}") for k in range(len(s["steps"]))]
        return TweedieTrees(s["base"], s["power"], trees, s["steps"])


def fit_tweedie(rows: DataFrame, n_trees: int, power: float = 1.24, step_size: float = 0.06, max_depth: int = 8,
                max_bins: int = 64, reg: float = 1.0, subsampling_rate: float = 1.0, seed: int = 42,
                label_col: str = "_label", weight_col: str = "_weight", write_every: int = 10,
                start: TweedieTrees | None = None) -> TweedieTrees:
    """Boost ``n_trees`` trees on rows with ``_features``; ``start`` goes on from an earlier model.

    Rows without a label or with a negative one take no part.  Without any positive label the model has no trees
    and predicts the smallest positive mean.
    """
    if not 1 < power < 2:
        raise ValueError("the variance power lies between 1 and 2")
    rows = rows.filter(F.col(label_col) >= 0).select("_features", F.col(label_col).cast("double").alias("_y"), F.col(weight_col).alias("_w"))
    if start is None:
        s = rows.agg((F.sum(F.col("_y") * F.col("_w")) / F.sum("_w")).alias("m")).first()[0] or 0.0
        model = TweedieTrees(math.log(s) if s > 0 else -700.0, power)
        if s <= 0:
            return model
    else:
        model = TweedieTrees(start.base, start.power, list(start.trees), list(start.steps))
        power = start.power
    data, written = cut_lineage(model.score(rows, out_col="_f"), "boost-rows"), len(model.trees)
    for k in range(len(model.trees), len(model.trees) + n_trees):
        if k - written >= write_every:
            data, written = cut_lineage(model.score(data, written, "_f", "_g").drop("_f").withColumnRenamed("_g", "_f"), "boost-rows"), k
        now = model.score(data, written, "_f")
        g, h = tweedie_gradient(F.col("_y"), F.col("_score"), power), tweedie_hessian(F.col("_y"), F.col("_score"), power)
        now = now.select("_features", "_w", g.alias("_grad"), h.alias("_hess"))
        drawn = now if subsampling_rate >= 1 else now.sample(False, subsampling_rate, seed + k)
        tree = DecisionTreeRegressor(featuresCol="_features", labelCol="_z", weightCol="_hw", maxDepth=max_depth,
                                     maxBins=max_bins, seed=seed + k, leafCol="_leaf").fit(
            drawn.select("_features", (-F.col("_grad") / F.col("_hess")).alias("_z"), (F.col("_hess") * F.col("_w")).alias("_hw")))
        leaves = newton_leaf_values(tree.transform(drawn), "_leaf", F.col("_grad"), F.col("_hess"), reg, F.col("_w"))
        found = {int(r["_leaf"]): r["step"] for r in leaves.collect()}  # a row a leaf: 2^max_depth at most
        steps = [step_size * found.get(leaf, 0.0) for leaf in range((tree.numNodes + 1) // 2)]
        model.trees.append(tree)
        model.steps.append(steps)
    return model
