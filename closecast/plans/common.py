"""Shared building blocks of the registered jobs (Spark side)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.operators.baselines import (
    BASELINE_FEATURES,
    FeatureColumnBaselineModel,
    fallback_mean,
    naive_prior,
)
from closecast.operators.splits import blocked_months, ordered_months
from closecast.plans.snapshots import input_key, snapshot_table

SEASONAL = "pred_seasonal"


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_table(spark, sf_dir)


def months(spark: SparkSession, sf_dir: str) -> list[str]:
    """The sorted month list of the (immutable) snapshot table, collected once."""
    key = input_key(spark, sf_dir)
    if key not in _MONTHS:
        _MONTHS[key] = ordered_months(snapshots(spark, sf_dir))
    return _MONTHS[key]


_MONTHS: dict[tuple, list[str]] = {}


def split_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots + blocked ``split`` column, using the memoised month list."""
    _, val_m, test_m = blocked_months(months(spark, sf_dir))
    month = F.col("accounting_month")
    return snapshots(spark, sf_dir).withColumn(
        "split", F.when(month.isin(test_m), F.lit("test")).when(month.isin(val_m), F.lit("validation"))
        .otherwise(F.lit("train")))


def baseline_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots + ``split`` + naive (PREDICTION) and seasonal (``pred_seasonal``)
    baselines fitted on the training block and applied to every row.

    Both baselines share one fit: the training-target mean (one aggregate)."""
    tagged = split_tagged(spark, sf_dir)
    fb = float(fallback_mean(tagged.where(F.col("split") == "train")).first()["fallback"])
    naive = FeatureColumnBaselineModel()._set(featureName=BASELINE_FEATURES["naive_prior"], fallback=fb)
    seas = FeatureColumnBaselineModel()._set(featureName=BASELINE_FEATURES["seasonal_naive"], fallback=fb,
                                             predictionCol=SEASONAL)
    return PipelineModel(stages=[naive, seas]).transform(tagged)


def naive_bundle(spark: SparkSession, sf_dir: str, run_id: str = "baseline-run"):
    from closecast.operators.scoring import ModelBundle

    train = split_tagged(spark, sf_dir).where(F.col("split") == "train").drop("split")
    model = PipelineModel(stages=[naive_prior().fit(train)])
    return ModelBundle("naive_prior", model, run_id=run_id)

