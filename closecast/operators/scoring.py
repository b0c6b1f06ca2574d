"""Batch scoring with lineage, checkpoint views.

Scoring is a narrow transformation (no shuffle): read -> project -> fitted
stages -> lineage literals -> write.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closecast.schema import DEMO_CUTOFF_DAY, FACILITY, KEYS, MONTH, PREDICTION, SNAPSHOT_DAY, TARGET

BASELINE_MODELS = {"naive_prior", "seasonal_naive"}
SCORED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scored_at_utc(spark: SparkSession, scored_at: str | None = None):
    """ISO-8601 UTC text for one batch: the given UTC wall-clock time, or now.

    Built from a TIMESTAMP_NTZ UTC wall clock, so it does not depend on the
    session time zone.
    """
    if scored_at:
        wall = F.lit(scored_at).cast("timestamp_ntz")
    else:
        tz = spark.conf.get("spark.sql.session.timeZone")
        wall = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.concat(F.date_format(wall, SCORED_AT_FORMAT), F.lit("+00:00"))


@dataclass
class ModelBundle:
    """Fitted pipeline (feature stage + estimator, or a baseline) + metadata."""

    model_name: str
    model: PipelineModel
    model_version: str = "0.1.0"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    trained_at: str = field(default_factory=lambda: _dt.datetime.now(_dt.UTC).isoformat())
    interval: object | None = None  # fitted random forest whose trees give the spread (B2); found in the model itself

    def __post_init__(self):
        last = self.model.stages[-1] if getattr(self.model, "stages", None) else None
        if self.interval is None and isinstance(last, RandomForestRegressionModel):
            self.interval = last

    @property
    def is_baseline(self) -> bool:
        return self.model_name in BASELINE_MODELS


def save_bundle(bundle: ModelBundle, path: str) -> str:
    """Spark ML writer for the pipeline + a JSON metadata file."""
    bundle.model.write().overwrite().save(os.path.join(path, "model"))
    meta = {k: getattr(bundle, k) for k in ("model_name", "model_version", "run_id", "trained_at")}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([meta]).coalesce(1).write.mode("overwrite").json(os.path.join(path, "metadata"))
    return path


def load_bundle(path: str) -> ModelBundle:
    spark = SparkSession.getActiveSession()
    meta = spark.read.json(os.path.join(path, "metadata")).first().asDict()
    return ModelBundle(model=PipelineModel.load(os.path.join(path, "model")), **meta)


def batch_score(bundle: ModelBundle, frame: DataFrame, cutoff_day: int | None = None,
                scored_at: str | None = None) -> DataFrame:
    """B1 + P9: keys + prediction (+ interval) + lineage columns.

    ``cutoff_day`` only stamps a column (default: the row's own snapshot day);
    use :func:`cutoff_filter` to restrict rows. ``scored_at`` is one timestamp
    per batch (default: the query's current timestamp).
    """
    if TARGET in frame.columns:
        frame = frame.drop(TARGET)
    scored = bundle.model.transform(frame)
    keys = [k for k in KEYS if k in frame.columns]
    cols = [F.col(k) for k in keys] + [F.col(PREDICTION).cast("double").alias(PREDICTION)]
    if bundle.interval is not None:
        from closecast.operators.models import interval_columns

        scored, icols = interval_columns(scored, bundle.interval)
        cols += icols
    cutoff = F.lit(cutoff_day).cast("bigint") if cutoff_day is not None else F.col(SNAPSHOT_DAY).cast("bigint")
    cols += [
        F.lit(bundle.model_name).alias("model_name"), F.lit(bundle.model_version).alias("model_version"),
        F.lit(bundle.run_id).alias("run_id"), cutoff.alias("cutoff_day"),
        scored_at_utc(frame.sparkSession, scored_at).alias("scored_at"),
    ]
    return scored.select(*cols)


def cutoff_filter(frame: DataFrame, day: int, fallback_day: int = DEMO_CUTOFF_DAY) -> DataFrame:
    """Rows at ``day``; when that day has no rows, the demo cutoff day.

    The existence probe is a ``limit(1)`` query, so it stops at the first hit.
    """
    at = frame.where(F.col(SNAPSHOT_DAY) == day)
    if at.limit(1).count() == 0:
        at = frame.where(F.col(SNAPSHOT_DAY) == fallback_day)
    return at


def score_cutoff_rows(scored_with_actual: DataFrame) -> DataFrame:
    """B4 rows: predicted / actual (2 places), APE (4 places, NULL if actual 0)."""
    y, p = F.col(TARGET), F.col(PREDICTION)
    ape = F.when(y != 0, F.abs(y - p) / F.abs(y))
    return scored_with_actual.select(
        *KEYS, F.round(p, 2).alias("predicted"), F.round(y, 2).alias("actual"),
        F.round(ape, 4).alias("abs_pct_error"))


def cutoff_wape(scored_with_actual: DataFrame) -> DataFrame:
    """B4 block: rows and unrounded WAPE of all scored rows at the cutoff."""
    from closecast.operators.metrics import metric_exprs

    return scored_with_actual.agg(F.count(F.lit(1)).alias("n"), metric_exprs(TARGET, PREDICTION)["wape"].alias("wape"))


def gross_to_net_rows(frame: DataFrame, day: int = DEMO_CUTOFF_DAY) -> DataFrame:
    """P8 items: gross, net (2 places) and their ratio (3 places, NULL if net is 0) of every row at the cutoff."""
    at = frame.where(F.col(SNAPSHOT_DAY) == day)
    gross, net = F.col("month_to_date_gross_charges"), F.col(TARGET)
    return at.select(FACILITY, MONTH, SNAPSHOT_DAY, F.round(gross, 2).alias("gross_charges"), F.round(net, 2).alias("net_revenue"),
                     F.round(F.when(net != 0, gross / net), 3).alias("gross_to_net_ratio"))


def gross_to_net(frame: DataFrame, day: int = DEMO_CUTOFF_DAY) -> DataFrame:
    """Gross / net at the cutoff: per facility-month row ratios are averaged
    over rows with a non-zero target (all rows, not a display sample)."""
    at = frame.where(F.col(SNAPSHOT_DAY) == day)
    net = F.col(TARGET)
    ratio = F.when(net != 0, F.col("month_to_date_gross_charges") / net)
    return at.agg(F.count(F.lit(1)).alias("n_rows"), F.count(ratio).alias("n_ratios"),
                  F.round(F.avg(ratio), 3).alias("average_gross_to_net_ratio"))


def latest_snapshot(frame: DataFrame, cutoff_day: int) -> DataFrame:
    """Newest snapshot per facility-month on or before ``cutoff_day``.

    A window partitioned by (facility, month) holds at most one row per
    configured snapshot day, so no partition grows with the data.
    """
    w = Window.partitionBy(FACILITY, MONTH).orderBy(F.col(SNAPSHOT_DAY).desc())
    return (frame.where(F.col(SNAPSHOT_DAY) <= cutoff_day)
            .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))
