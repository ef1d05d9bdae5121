"""Demand model on Spark ML: feature list, training, leakage check, prediction, time-series CV.

Gradient-boosted trees (``GBTRegressor``) train distributed on the product-day
panel; the label is ``log1p(quantity)`` and price-change days may be
up-weighted.  String features (a product code has far more levels than
``maxBins``) are target-encoded by grouped aggregates that are joined back, so
no label map ever reaches the driver; a training row's encoding leaves its own
fold out.  NULL numerics get a sentinel plus a missing flag so no row is
dropped.  ``loss="squared"`` boosts Spark's GBT on squared error of log1p,
``loss="tweedie"`` the trees of ``boosting`` on Tweedie deviance of it.  The
numbers differ from the reference's booster by design; the checks are R^2,
deviance and elasticity signs, not equality.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio, round_half_up
from ..session import checkpoint_dir, cut_lineage
from .boosting import TweedieTrees, fit_tweedie
from .weekly import last_value

MISSING = -1.0e9
FOLDS, PRIOR = 5, 10.0

# Columns that never are features.
EXCLUDED = ["date", "revenue_before", "revenue_after", "product_buying_price", "cpi", "valid_from", "valid_to",
            "product_id", "yearweek", "year_week", "is_test", "n_lines"]


@dataclass
class ModelConfig:
    target: str = "quantity_sold"
    price_col: str = "product_selling_price"
    # the reference booster uses 1700 trees / 782 leaves; Spark GBT grows depth-limited trees
    max_iter: int = 100
    max_depth: int = 8
    step_size: float = 0.06
    subsampling_rate: float = 1.0
    max_bins: int = 64
    seed: int = 42
    price_change_weight: float = 1.0
    loss: str = "squared"  # or "tweedie"
    variance_power: float = 1.24
    leakage_warn_r2: float = 0.82
    leakage_alert_r2: float = 0.87
    max_broadcast_levels: int = 50_000
    exclude: Sequence[str] = field(default_factory=lambda: list(EXCLUDED))


@dataclass
class DemandModel:
    """Trees, the encodings (feature, level, value) of the string features, and how many levels they have."""
    trees: GBTRegressionModel | TweedieTrees
    features: list[str]
    strings: list[str]
    inputs: list[str]
    encodings: DataFrame
    levels: int
    mean: float
    config: ModelConfig

    def save(self, path: str) -> None:
        """Trees, encodings and settings below ``path`` (replaced if there)."""
        spark = self.encodings.sparkSession
        if isinstance(self.trees, TweedieTrees):
            self.trees.save(f"{path}/trees")
        else:
            self.trees.write().overwrite().save(f"{path}/trees")
        self.encodings.write.mode("overwrite").parquet(f"{path}/encodings")
        settings = [(self.features, self.strings, self.inputs, self.levels, self.mean)]
        (spark.createDataFrame(settings, "features array<string>, strings array<string>, inputs array<string>, levels long, "
                               "mean double").coalesce(1).write.mode("overwrite").json(f"{path}/settings"))


def load_model(spark: SparkSession, path: str, config: ModelConfig | None = None) -> DemandModel:
    s = spark.read.schema("features array<string>, strings array<string>, inputs array<string>, levels long, "
                          "mean double").json(f"{path}/settings").first()
    config = config or ModelConfig()
    trees = TweedieTrees.load(spark, f"{path}/trees") if config.loss == "tweedie" else GBTRegressionModel.load(f"{path}/trees")
    return DemandModel(trees, list(s["features"]), list(s["strings"]),
                       list(s["inputs"]), spark.read.parquet(f"{path}/encodings"), s["levels"], s["mean"], config)


def feature_columns(df: DataFrame, cfg: ModelConfig, competitor_price_cols: Sequence[str] = ()) -> list[str]:
    """All columns except the target, the exclusion list, raw competitor prices (leak guards) and
    raw lag columns (their information stays in the price-change features)."""
    skip = {cfg.target, *cfg.exclude, *competitor_price_cols}
    return [c for c in df.columns if c not in skip and not ("_lag_" in c and not c.startswith("price_change_"))]


def _numeric(df: DataFrame, feats: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Numeric/boolean features -> double with a missing sentinel and flag."""
    cols = {}
    for c in feats:
        x = F.col(c).cast("double")
        cols[f"_f_{c}"] = F.coalesce(F.when(~F.isnan(x), x), F.lit(MISSING))
        cols[f"_m_{c}"] = F.col(c).isNull().cast("double")
    return df.withColumns(cols), [f"_f_{c}" for c in feats] + [f"_m_{c}" for c in feats]


def _sized(table: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hint a broadcast only below a counted size; otherwise the optimizer's shuffle join stands."""
    return F.broadcast(table) if rows <= limit else table


def _smooth(total, count, mean: float):
    """Mean label of a level, drawn to the overall mean by ``PRIOR`` rows."""
    return (F.coalesce(total, F.lit(0.0)) + PRIOR * mean) / (F.coalesce(count, F.lit(0)) + PRIOR)


def _labelled(train: DataFrame, cfg: ModelConfig) -> DataFrame:
    lag1 = f"price_change_{cfg.price_col}_lag_1"
    weight = F.lit(1.0)
    if cfg.price_change_weight > 1 and lag1 in train.columns:
        weight = F.when(F.coalesce(F.col(lag1), F.lit(0.0)) != 0, F.lit(float(cfg.price_change_weight))) \
            .otherwise(F.lit(1.0))
    return train.withColumn("_label", F.log1p(F.col(cfg.target))).withColumn("_weight", weight)


def encode_training(train: DataFrame, cfg: ModelConfig, feats: Sequence[str]):
    """(training rows with model inputs, a DemandModel without trees).

    Every string feature is encoded by the smoothed mean label of its level: for the model over all rows,
    for a training row over the rows of the other folds.  Rows are written once for the many tree passes.
    """
    types = dict(train.dtypes)
    strings = [c for c in feats if types[c] == "string"]
    data, inputs = _numeric(_labelled(train, cfg), [c for c in feats if c not in strings])
    data = data.withColumn("_fold", F.pmod(F.xxhash64(*feats), F.lit(FOLDS)))
    mean = data.agg(F.avg("_label")).first()[0] or 0.0
    spark, tables, levels = train.sparkSession, [], 0
    for c in strings:
        by_fold = cut_lineage(data.groupBy(F.col(c).alias("level"), "_fold").agg(
            F.sum("_label").alias("s"), F.count("_label").alias("n")), "encoding")
        total = by_fold.groupBy(F.col("level").alias("_level")).agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
        rows = by_fold.count()
        own = by_fold.join(total, F.col("level").eqNullSafe(F.col("_level"))).select(
            F.col("_level"), F.col("_fold").alias("_of"),
            _smooth(F.col("ts") - F.col("s"), F.col("tn") - F.col("n"), mean).alias(f"_e_{c}"))
        data = data.join(_sized(own, rows, cfg.max_broadcast_levels),
                         data[c].eqNullSafe(F.col("_level")) & (F.col("_fold") == F.col("_of")), "left").drop("_level", "_of")
        tables.append(total.select(F.lit(c).alias("feature"), F.col("_level").alias("level"), _smooth(F.col("ts"), F.col("tn"), mean).alias("value")))
        levels = max(levels, rows)
    encodings = spark.createDataFrame([], "feature string, level string, value double")
    for t in tables:
        encodings = encodings.unionByName(t)
    inputs += [f"_e_{c}" for c in strings]
    data = cut_lineage(data.select(*inputs, "_label", "_weight"), "training")
    return data, DemandModel(None, list(feats), strings, inputs, cut_lineage(encodings, "encodings"), levels, float(mean), cfg)


def fit_trees(data: DataFrame, model: DemandModel, cfg: ModelConfig) -> DemandModel:
    """Fit the boosted trees on encoded rows.  Iterations checkpoint into the shared checkpoint folder, so a
    lost executor does not replay the whole boosting lineage."""
    checkpoint_dir(data.sparkSession)
    vectors = VectorAssembler(inputCols=model.inputs, outputCol="_features", handleInvalid="keep").transform(data)
    if cfg.loss == "tweedie":
        trees = fit_tweedie(vectors, cfg.max_iter, cfg.variance_power, cfg.step_size, cfg.max_depth, cfg.max_bins,
                            subsampling_rate=cfg.subsampling_rate, seed=cfg.seed)
        return replace(model, trees=trees, config=cfg)
    trees = GBTRegressor(featuresCol="_features", labelCol="_label", weightCol="_weight",
                         maxIter=cfg.max_iter, maxDepth=cfg.max_depth, stepSize=cfg.step_size,
                         subsamplingRate=cfg.subsampling_rate, maxBins=cfg.max_bins, seed=cfg.seed,
                         checkpointInterval=10).fit(vectors)
    return replace(model, trees=trees, config=cfg)


def train_demand_model(train: DataFrame, cfg: ModelConfig, feats: Sequence[str]) -> DemandModel:
    """Encode the training rows and fit the trees on ``log1p(target)``."""
    return fit_trees(*encode_training(train, cfg, feats), cfg)


def model_inputs(model: DemandModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's input vector; levels not seen in training get the overall mean."""
    data, _ = _numeric(df, [c for c in model.features if c not in model.strings])
    for c in model.strings:
        table = model.encodings.filter(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("value").alias("_v"))
        data = (data.join(_sized(table, model.levels, model.config.max_broadcast_levels),
                          data[c].eqNullSafe(F.col("_level")), "left")
                .withColumn(f"_e_{c}", F.coalesce("_v", F.lit(model.mean))).drop("_level", "_v"))
    return VectorAssembler(inputCols=model.inputs, outputCol="_features", handleInvalid="keep").transform(data)


def predict_quantity(model: DemandModel, df: DataFrame, feats: Sequence[str] | None = None,
                     out_col: str = "predicted_quantity") -> DataFrame:
    """max(expm1(prediction), 0) appended to ``df``'s own columns."""
    scored = model.trees.transform(model_inputs(model, df))
    return scored.select(*df.columns, F.greatest(F.expm1("prediction"), F.lit(0.0)).alias(out_col))


def fit_quality(scored: DataFrame, cfg: ModelConfig, pred_col: str) -> DataFrame:
    """One row: hold-out R^2 of a prediction and its status ok / warning / error (too good is suspicious)."""
    y, p = F.col(cfg.target), F.col(pred_col)
    used = scored.filter(y.isNotNull() & p.isNotNull())
    r2 = 1 - ratio(F.sum((y - p) * (y - p)), F.count(y) * F.var_pop(y))
    return used.agg(r2.alias("holdout_r2")).withColumn("status", F.when(
        F.col("holdout_r2") > cfg.leakage_alert_r2, "error").when(
        F.col("holdout_r2") > cfg.leakage_warn_r2, "warning").otherwise("ok"))


def leakage_check(model: DemandModel, holdout: DataFrame, cfg: ModelConfig, feats: Sequence[str] | None = None,
                  top_k: int = 5) -> DataFrame:
    """Hold-out R^2 at actual prices -> status, with the top features by importance."""
    weights = model.trees.featureImportances.toArray().tolist()
    top = sorted(zip(model.inputs, weights), key=lambda t: (-t[1], t[0]))[:top_k]
    named = ", ".join(f"{n.removeprefix('_f_').removeprefix('_e_')}={v:.4f}" for n, v in top)
    return fit_quality(predict_quantity(model, holdout, out_col="_pred"), cfg, "_pred").withColumn(
        "top_features", F.lit(named))


def last_actual_price(df: DataFrame, price_col: str, key: str = "product_code", date_col: str = "date") -> DataFrame:
    """Per key the latest price that is not NULL."""
    return df.groupBy(key).agg(last_value(price_col, date_col).alias(price_col))


def estimations(predictions_per_day: DataFrame, panel: DataFrame, price_col: str = "product_selling_price",
                key: str = "product_code") -> DataFrame:
    """Sum predicted quantity per (product, simulated price), join the last actual price, round 2."""
    calc = f"{price_col}_calc"
    summed = predictions_per_day.groupBy(key, calc).agg(F.sum("predicted_quantity").alias("predicted_quantity"))
    out = summed.join(last_actual_price(panel, price_col, key), key, "left")
    return out.select(key, round_half_up(calc, 2).alias(calc), round_half_up("predicted_quantity", 2).alias("predicted_quantity"),
                      round_half_up(price_col, 2).alias(price_col))


def expanding_folds(df: DataFrame, n_folds: int = 3, date_col: str = "date") -> DataFrame:
    """Fold id per date: dates are cut into n_folds + 1 equal blocks by rank; fold i trains on
    blocks <= i and validates on block i + 1 (time-ordered, never by row position)."""
    days = df.select(date_col).distinct()
    # one row per distinct day: the ranking window is bounded by the calendar
    ranked = days.withColumn("_block", F.ntile(n_folds + 1).over(Window.orderBy(date_col)) - 1)
    return df.join(F.broadcast(ranked), date_col)


@dataclass
class _Fold:
    train: DataFrame
    valid: DataFrame
    encoded: DemandModel

    def rmse(self, cfg: ModelConfig) -> float:
        """Validation RMSE (on log1p) of a model fitted with these settings."""
        model = fit_trees(self.train, self.encoded, cfg)
        evaluator = RegressionEvaluator(labelCol="_label", predictionCol="prediction", metricName="rmse")
        return float(evaluator.evaluate(model.trees.transform(self.valid)))


def _encoded_fold(blocks: DataFrame, k: int, cfg: ModelConfig, feats: Sequence[str]) -> _Fold:
    train, encoded = encode_training(blocks.filter(F.col("_block") <= k), cfg, feats)
    valid = model_inputs(encoded, _labelled(blocks.filter(F.col("_block") == k + 1), cfg))
    return _Fold(train, cut_lineage(valid.select("_features", "_label"), "cv-valid"), encoded)


def _together(spark: SparkSession, jobs: Sequence[Callable], parallel: int) -> list:
    """Results of the jobs in order, ``parallel`` at a time: small fits leave most of a cluster idle one by one."""
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def time_series_cv(df: DataFrame, cfg: ModelConfig, feats: Sequence[str], grid: Sequence[dict],
                   n_folds: int = 3) -> DataFrame:
    """Mean validation RMSE (on log1p) per parameter set over expanding-window folds, one fit after another.

    Rows are encoded and written once per fold; every parameter set reads them.
    """
    blocks = cut_lineage(expanding_folds(df, n_folds), "cv-blocks")
    folds = [_encoded_fold(blocks, k, cfg, feats) for k in range(n_folds)]
    rows = [(i, str(sorted(p.items())), sum(f.rmse(replace(cfg, **p)) for f in folds) / n_folds) for i, p in enumerate(grid)]
    return df.sparkSession.createDataFrame(rows, "param_set int, params string, rmse double")


def successive_halving(df: DataFrame, cfg: ModelConfig, feats: Sequence[str], grid: Sequence[dict], n_folds: int = 3,
                       first_trees: int = 2, most_trees: int = 16, parallel: int = 8) -> DataFrame:
    """Search over settings: all of them on few trees, the better half on twice as many, and so on.

    Folds are those of ``time_series_cv``, encoded and written once.  The fits of a round (settings x folds) are
    Spark jobs that run ``parallel`` at a time.  The search ends at ``most_trees`` trees or one setting.  One row per
    setting: ``trees`` of its last round, the mean ``rmse`` of that round, and ``rank`` (1 is best; a setting that
    went further stands before one that did not; ties by the order of the grid).
    """
    spark = df.sparkSession
    blocks = cut_lineage(expanding_folds(df, n_folds), "cv-blocks")
    folds = _together(spark, [lambda k=k: _encoded_fold(blocks, k, cfg, feats) for k in range(n_folds)], parallel)
    alive, trees, last = list(range(len(grid))), first_trees, {}
    while alive:
        settings = [replace(cfg, **{**grid[i], "max_iter": trees}) for i in alive]
        got = _together(spark, [lambda f=f, c=c: f.rmse(c) for c in settings for f in folds], parallel)
        for n, i in enumerate(alive):
            last[i] = (trees, sum(got[n * n_folds:(n + 1) * n_folds]) / n_folds)
        alive.sort(key=lambda i: (last[i][1], i))
        if trees >= most_trees or len(alive) == 1:
            break
        alive, trees = sorted(alive[:(len(alive) + 1) // 2]), min(2 * trees, most_trees)
    order = sorted(last, key=lambda i: (-last[i][0], last[i][1], i))
    rows = [(i, str(sorted(grid[i].items())), last[i][0], last[i][1], order.index(i) + 1) for i in range(len(grid))]
    return spark.createDataFrame(rows, "param_set int, params string, trees int, rmse double, rank int")
