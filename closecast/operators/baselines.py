"""Naive baselines as Spark ML stages.

Fit = one aggregate (the training-target mean, computed as an exact DECIMAL
sum / count so it does not depend on partitioning). Predict = one projection:
``coalesce(feature, fallback)``.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.functions.columns import finite_or_null
from closecast.schema import PREDICTION, TARGET

BASELINE_FEATURES = {
    "naive_prior": "prior_month_net_revenue",
    "seasonal_naive": "prior_year_same_month_net_revenue",
}


def exact_mean(col: str, scale: int = 4):
    """Mean of finite values via an exact DECIMAL sum (order-independent)."""
    v = finite_or_null(F.col(col).cast("double"))
    return F.try_divide(F.sum(v.cast(f"decimal(38,{scale})")).cast("double"), F.count(v).cast("double"))


def fallback_mean(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row ``fallback`` = mean of non-null training target, 0.0 if none."""
    return df.agg(F.coalesce(exact_mean(label), F.lit(0.0)).alias("fallback"))


class _BaselineParams(Params):
    featureName = Param(Params._dummy(), "featureName", "history column predicted as-is",
                        typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "target column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol=TARGET, predictionCol=PREDICTION)


class FeatureColumnBaseline(Estimator, _BaselineParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, featureName: str = "prior_month_net_revenue"):
        super().__init__()
        self._set(featureName=featureName)

    def _fit(self, dataset: DataFrame) -> "FeatureColumnBaselineModel":
        fb = fallback_mean(dataset, self.getOrDefault("labelCol")).first()["fallback"]
        m = FeatureColumnBaselineModel()
        m._set(featureName=self.getOrDefault("featureName"), fallback=float(fb),
               labelCol=self.getOrDefault("labelCol"), predictionCol=self.getOrDefault("predictionCol"))
        return m


class FeatureColumnBaselineModel(Model, _BaselineParams, DefaultParamsReadable, DefaultParamsWritable):
    fallback = Param(Params._dummy(), "fallback", "training target mean", typeConverter=TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault("featureName")
        raw = finite_or_null(F.col(name).try_cast("double")) if name in dataset.columns else F.lit(None).cast("double")
        pred = F.coalesce(raw, F.lit(float(self.getOrDefault("fallback"))))
        return dataset.withColumn(self.getOrDefault("predictionCol"), pred)


def naive_prior() -> FeatureColumnBaseline:
    return FeatureColumnBaseline(BASELINE_FEATURES["naive_prior"])


def seasonal_naive() -> FeatureColumnBaseline:
    return FeatureColumnBaseline(BASELINE_FEATURES["seasonal_naive"])
