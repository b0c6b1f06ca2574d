"""K1-K3, K5: checkpoint WAPE targets and the beat-baseline KPI as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.operators.metrics import metric_exprs
from closecast.schema import FACILITY, PREDICTION, SNAPSHOT_DAY, TARGET


@dataclass(frozen=True)
class CheckpointTarget:
    label: str
    snapshot_day: int
    wape_max: float
    by_facility_wape_max: float | None = None


# fixed values: the published checkpoint ceilings
DEFAULT_TARGETS = [
    CheckpointTarget("Day 10 (early read)", 10, 0.07),
    CheckpointTarget("Day 15 (primary)", 15, 0.04, by_facility_wape_max=0.05),
    CheckpointTarget("Day 21 (second)", 21, 0.04),
]
BASELINE_KPI_NAME = "Beat manual analyst baseline"

SCORECARD_COLUMNS = ["checkpoint", "snapshot_day", "metric", "value", "target", "met", "margin"]


def targets_frame(spark: SparkSession, targets: list[CheckpointTarget] | None = None) -> DataFrame:
    rows = [(t.label, t.snapshot_day, t.wape_max, t.by_facility_wape_max) for t in (targets or DEFAULT_TARGETS)]
    return spark.createDataFrame(
        rows, "checkpoint string, snapshot_day bigint, wape_max double, by_facility_wape_max double")


def checkpoint_targets(by_day: DataFrame, targets: list[CheckpointTarget] | None = None) -> DataFrame:
    """K1: by-day WAPE joined to the (tiny, broadcast) target table; absent days skipped."""
    t = targets_frame(by_day.sparkSession, targets)
    j = by_day.select(F.col(SNAPSHOT_DAY).cast("bigint").alias(SNAPSHOT_DAY), "wape").join(
        F.broadcast(t), SNAPSHOT_DAY, "inner")
    return j.select(
        "checkpoint", SNAPSHOT_DAY, F.lit("wape").alias("metric"),
        F.round("wape", 4).alias("value"), F.col("wape_max").alias("target"),
        F.coalesce(F.col("wape") <= F.col("wape_max"), F.lit(False)).alias("met"),
        F.round(F.col("wape_max") - F.col("wape"), 4).alias("margin"),
    )


def beats_baseline_row(df_with_wapes: DataFrame, champion_col: str = "champion_wape",
                       baseline_col: str = "baseline_wape") -> DataFrame:
    """K2 on a one-row frame carrying both WAPEs."""
    c, b = F.col(champion_col), F.col(baseline_col)
    return df_with_wapes.select(
        F.lit(BASELINE_KPI_NAME).alias("checkpoint"), F.lit(None).cast("bigint").alias(SNAPSHOT_DAY),
        F.lit("wape").alias("metric"), F.round(c, 4).alias("value"), F.round(b, 4).alias("target"),
        F.coalesce(c < b, F.lit(False)).alias("met"), F.round(b - c, 4).alias("margin"),
    )


def kpi_scorecard(by_day: DataFrame, baseline: DataFrame | None = None,
                  targets: list[CheckpointTarget] | None = None) -> DataFrame:
    """K3: K1 rows, plus the K2 row when a one-row baseline frame is given."""
    card = checkpoint_targets(by_day, targets)
    if baseline is not None:
        card = card.unionByName(beats_baseline_row(baseline))
    return card.select(*SCORECARD_COLUMNS)


def scorecard_for(scored: DataFrame, baseline_pred: str | None = None, y: str = TARGET, p: str = PREDICTION,
                  targets: list[CheckpointTarget] | None = None) -> DataFrame:
    """K3 straight from scored rows: by-day WAPE and, optionally, the WAPE of a
    baseline prediction column on the same rows (one aggregate, no join)."""
    by_day = scored.groupBy(SNAPSHOT_DAY).agg(metric_exprs(y, p)["wape"].alias("wape"))
    base = None
    if baseline_pred is not None:
        base = scored.agg(metric_exprs(y, p)["wape"].alias("champion_wape"),
                          metric_exprs(y, baseline_pred)["wape"].alias("baseline_wape"))
    return kpi_scorecard(by_day, base, targets)


def facility_targets(scored: DataFrame, y: str = TARGET, p: str = PREDICTION,
                     targets: list[CheckpointTarget] | None = None) -> DataFrame:
    """K5: per-facility WAPE at each checkpoint that declares a facility ceiling."""
    t = targets_frame(scored.sparkSession, targets).where(F.col("by_facility_wape_max").isNotNull())
    by = scored.groupBy(FACILITY, F.col(SNAPSHOT_DAY).cast("bigint").alias(SNAPSHOT_DAY)).agg(
        F.count(F.lit(1)).alias("n"), metric_exprs(y, p)["wape"].alias("wape"))
    j = by.join(F.broadcast(t), SNAPSHOT_DAY, "inner")
    return j.select(
        "checkpoint", FACILITY, SNAPSHOT_DAY, "n", F.round("wape", 4).alias("value"),
        F.col("by_facility_wape_max").alias("target"),
        F.coalesce(F.col("wape") <= F.col("by_facility_wape_max"), F.lit(False)).alias("met"),
        F.round(F.col("by_facility_wape_max") - F.col("wape"), 4).alias("margin"),
    )
