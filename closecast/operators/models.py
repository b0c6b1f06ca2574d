"""Candidate regressors on Spark ML, training and tuning.

Features are fitted once on the training block and cached; every learned
candidate trains on that cached frame (the reference rebuilt features per
candidate). Boosted candidates are ``boosting.HistogramBoosting``, fitted
together in shared passes; the forest is Spark's.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.operators.baselines import BASELINE_FEATURES, FeatureColumnBaseline
from closecast.operators.boosting import Boosting, HistogramBoosting, fit_together, over_vectors, saved_nodes
from closecast.operators.features import LeakageSafeFeatures
from closecast.operators.splits import TemporalSplit
from closecast.schema import PREDICTION, TARGET


# fixed values: the published candidate list and hyper-parameters
@dataclass
class ModelConfig:
    candidates: list[str] = field(default_factory=lambda: [
        "naive_prior", "seasonal_naive", "elastic_net", "gradient_boosting", "hist_gradient_boosting", "xgboost"])
    primary_metric: str = "wape"
    random_state: int = 42
    gbr_params: dict = field(default_factory=lambda: {"n_estimators": 300, "max_depth": 3,
                                                      "learning_rate": 0.05, "subsample": 0.9})
    hgb_params: dict = field(default_factory=lambda: {"max_iter": 300, "learning_rate": 0.05, "max_depth": 6})
    xgboost_params: dict = field(default_factory=lambda: {"n_estimators": 300, "max_depth": 5,
                                                          "learning_rate": 0.05, "subsample": 0.9,
                                                          "colsample_bytree": 0.9, "reg_lambda": 1.0})
    rf_params: dict = field(default_factory=lambda: {"n_estimators": 300, "max_depth": 12})
    elastic_net_params: dict = field(default_factory=lambda: {"alpha": 0.5, "l1_ratio": 0.3, "max_iter": 10000})


class ScaledElasticNet(Estimator):
    """L3: elastic net whose penalties match the (alpha, l1_ratio) objective on
    standardized features. Spark scales the label inside the solver, so the L2
    share is multiplied by the sample std of the training target."""

    def __init__(self, alpha: float = 0.5, l1_ratio: float = 0.3, max_iter: int = 10000,
                 featuresCol: str = "features", labelCol: str = TARGET, predictionCol: str = PREDICTION):
        super().__init__()
        self.alpha, self.l1_ratio, self.max_iter = alpha, l1_ratio, max_iter
        self.featuresCol, self.labelCol, self.predictionCol = featuresCol, labelCol, predictionCol

    def _fit(self, dataset: DataFrame):
        sd = dataset.agg(F.stddev_samp(self.labelCol)).first()[0] or 0.0
        l1 = self.alpha * self.l1_ratio
        l2 = self.alpha * (1.0 - self.l1_ratio) * float(sd)
        reg = l1 + l2
        lr = LinearRegression(featuresCol=self.featuresCol, labelCol=self.labelCol,
                              predictionCol=self.predictionCol, maxIter=self.max_iter,
                              regParam=reg, elasticNetParam=(l1 / reg) if reg > 0 else 0.0,
                              standardization=True, solver="auto")
        return lr.fit(dataset)


def _elastic_net(config: ModelConfig, col: str, common: dict):
    p = config.elastic_net_params
    return Pipeline(stages=[
        StandardScaler(inputCol=col, outputCol="scaled_features", withMean=True, withStd=True),
        ScaledElasticNet(p["alpha"], p["l1_ratio"], p["max_iter"], featuresCol="scaled_features"),
    ])


#: name -> settings of a boosted candidate. The histogram candidate grows best-first
#: to 31 leaves of at least 20 rows; ``xgboost`` adds the L2 penalty to gains and leaves.
BOOSTED = {
    "gradient_boosting": lambda c: Boosting(c.gbr_params["n_estimators"], c.gbr_params["max_depth"], c.gbr_params["learning_rate"],
                                            row_share=c.gbr_params["subsample"], seed=c.random_state),
    "hist_gradient_boosting": lambda c: Boosting(c.hgb_params["max_iter"], c.hgb_params["max_depth"], c.hgb_params["learning_rate"],
                                                 max_leaves=31, min_rows=20, seed=c.random_state),
    "xgboost": lambda c: Boosting(c.xgboost_params["n_estimators"], c.xgboost_params["max_depth"], c.xgboost_params["learning_rate"],
                                  l2=c.xgboost_params["reg_lambda"], row_share=c.xgboost_params["subsample"],
                                  column_share=c.xgboost_params["colsample_bytree"], seed=c.random_state),
}

#: name -> builder(config, features column, common arguments)
BUILDERS = {
    **{name: (lambda config, col, common, n=name: FeatureColumnBaseline(BASELINE_FEATURES[n])) for name in BASELINE_FEATURES},
    "elastic_net": _elastic_net,
    **{name: (lambda config, col, common, n=name: HistogramBoosting(BOOSTED[n](config), featuresCol=col)) for name in BOOSTED},
    "random_forest": lambda c, col, common: RandomForestRegressor(numTrees=c.rf_params["n_estimators"], maxDepth=c.rf_params["max_depth"],
                                                                  maxMemoryInMB=1024, cacheNodeIds=True, **common),
}


def supported_models() -> list[str]:
    return list(BUILDERS)


def build_estimator(name: str, config: ModelConfig | None = None, features_col: str = "features"):
    """Name -> unfitted estimator reading ``features_col`` (baselines read raw rows)."""
    if name not in BUILDERS:
        raise ValueError(f"Unknown model candidate {name!r}; known: {', '.join(BUILDERS)}")
    config = config or ModelConfig()
    return BUILDERS[name](config, features_col, dict(featuresCol=features_col, labelCol=TARGET, predictionCol=PREDICTION, seed=config.random_state))


@dataclass
class TrainingResult:
    name: str
    model: PipelineModel
    test_scored: DataFrame
    metrics: DataFrame
    by_facility: DataFrame
    by_day: DataFrame


@dataclass
class FeatureCache:
    """Features fitted on train once, applied to validation/test, cached."""

    model: object
    train: DataFrame
    validation: DataFrame
    test: DataFrame

    def release(self):
        for df in (self.train, self.validation, self.test):
            df.unpersist()


TASK_BYTES = 32 << 20
TASK_ROWS = 4096


def _cached(df: DataFrame, width: int) -> DataFrame:
    """``df`` cached in as many partitions as its bytes need, or as its rows can keep cores busy: fitting runs many short jobs over it."""
    rows = df.count()
    busy = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.coalesce(max(1, busy, -(-rows * width * 8 // TASK_BYTES))).cache()


def fit_features(split: TemporalSplit) -> FeatureCache:
    fm = LeakageSafeFeatures(outputCol="features").fit(split.train)
    width = len(fm.feature_names())
    return FeatureCache(fm, *[_cached(fm.transform(f), width) for f in (split.train, split.validation, split.test)])


def tune_learning_rate(split: TemporalSplit, rates=(0.03, 0.05, 0.1, 0.2), block: str = "validation",
                       config: ModelConfig | None = None, cache: FeatureCache | None = None,
                       fitted: dict | None = None) -> DataFrame:
    """Hist-gradient-boosting learning-rate sweep scored by WAPE on the
    validation block (``block='test'`` reproduces the optimistic variant).
    All rates are fitted together, in shared passes over one binned frame;
    ``fitted`` may pass models already trained for some rates (same data)."""
    from closecast.operators.metrics import metric_exprs

    config = config or ModelConfig()
    own = cache is None
    cache = cache or fit_features(split)
    target = cache.validation if block == "validation" else cache.test
    models = dict(fitted or {})
    todo = [lr for lr in rates if lr not in models]
    if todo:
        settings = [ModelConfig(**{**config.__dict__, "hgb_params": {**config.hgb_params, "learning_rate": lr}}) for lr in todo]
        models |= dict(zip(todo, fit_together([build_estimator("hist_gradient_boosting", c) for c in settings], cache.train), strict=True))
    rows = [(f"learning_rate={lr}", float(lr), models[lr].transform(target).agg(metric_exprs()["wape"]).first()[0]) for lr in rates]
    if own:
        cache.release()
    best = min(w for *_, w in rows)
    return split.train.sparkSession.createDataFrame([(*r, r[2] == best) for r in rows],
                                                    "setting string, learning_rate double, wape double, is_best boolean")


# -- B2: per-tree spread of a random forest ---------------------------------
def leaf_values(forest) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): leaf k of member t predicts values[starts[t] + k], in the order that the model numbers its leaves."""
    nodes = saved_nodes(forest)
    leaves = nodes[nodes["left"] < 0].sort_values(["tree", "id"])
    sizes = np.bincount(leaves["tree"], minlength=forest.getNumTrees)
    return leaves["prediction"].to_numpy(), np.concatenate([[0], np.cumsum(sizes)[:-1]])


def interval_columns(scored: DataFrame, forest) -> tuple[DataFrame, list]:
    """Population std of the member trees' predictions and +-1.96 std bounds.

    One JVM pass names each row's leaf in every member (``leafCol``); a look-up in the
    forest's flat leaf values, which are broadcast, gives the members' predictions by batch.
    """
    shared = scored.sparkSession.sparkContext.broadcast(leaf_values(forest))  # the model's size

    def spread(leaves: np.ndarray) -> pa.Array:
        values, starts = shared.value
        return pa.array(values[leaves.astype(np.int64) + starts].std(axis=1) if len(leaves) else np.zeros(0))

    with_leaves = forest.copy().setLeafCol("_leaves").setPredictionCol("_again").transform(scored)
    out = with_leaves.withColumn("prediction_std", over_vectors("_leaves", spread, "double")).drop("_leaves", "_again")
    p = F.col(PREDICTION)
    cols = [F.col("prediction_std"), (p - 1.96 * F.col("prediction_std")).alias("prediction_lower"),
            (p + 1.96 * F.col("prediction_std")).alias("prediction_upper")]
    return out, cols
