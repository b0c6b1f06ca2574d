"""Accuracy metrics as single-pass aggregate expressions.

Every metric is a built-in aggregate, so partial aggregation happens map-side
and a grouped metric table costs one small shuffle whatever the row count.
Degenerate groups give NULL (the reference's NaN). A missing actual or
prediction fails the job inside the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closecast.schema import FACILITY, PREDICTION, SNAPSHOT_DAY, TARGET

METRIC_NAMES = ["wape", "bias", "mae", "rmse", "mape", "smape", "r2"]
_EPS = 1e-9


#: Places of each metric in a report. Operators return and compare full precision.
REPORT_PLACES = {"wape": 6, "bias": 6, "mae": 3, "rmse": 3, "smape": 6, "r2": 6}


def reported(df: DataFrame) -> DataFrame:
    """A metric table rounded for a report; never read it to decide anything.

    A MAPE has no scale (an actual near 0 makes it 1e12), so it is given in
    single precision, about seven digits, instead of places."""
    def one(c):
        return F.col(c).cast("float").cast("double").alias(c) if c == "mape" else F.round(c, REPORT_PLACES[c]).alias(c) if c in REPORT_PLACES else F.col(c)
    return df.select(*[one(c) for c in df.columns])


def _guarded(y: str, p: str) -> tuple[Column, Column]:
    """Actual and prediction; a row without either fails the job, in the same pass."""
    yt, yp = F.col(y).cast("double"), F.col(p).cast("double")
    bad = yt.isNull() | yp.isNull() | F.isnan(yt) | F.isnan(yp)
    fail = F.raise_error(F.lit(f"a row has no {y} or no {p}")).cast("double")
    return F.when(bad, fail).otherwise(yt), F.when(bad, fail).otherwise(yp)


def metric_exprs(y: str = TARGET, p: str = PREDICTION) -> dict[str, Column]:
    """name -> aggregate Column for the seven metrics."""
    yt, yp = _guarded(y, p)
    err = yt - yp
    abs_err = F.abs(err)
    sum_abs_y = F.sum(F.abs(yt))
    sum_y = F.sum(yt)
    n = F.count(F.lit(1))
    denom_s = F.abs(yt) + F.abs(yp)
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(yt) * n
    r2 = (
        F.when(n <= 1, F.lit(None).cast("double"))
        .when(F.min(yt) == F.max(yt), F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - ss_res / ss_tot)
    )
    return {
        "wape": F.when(sum_abs_y < _EPS, F.lit(None).cast("double")).otherwise(F.sum(abs_err) / sum_abs_y),
        "bias": F.when(F.abs(sum_y) < _EPS, F.lit(None).cast("double")).otherwise(F.sum(yp - yt) / sum_y),
        "mae": F.avg(abs_err),
        "rmse": F.sqrt(F.avg(err * err)),
        "mape": F.avg(abs_err / F.when(F.abs(yt) < _EPS, F.lit(_EPS)).otherwise(F.abs(yt))),
        "smape": F.avg(F.lit(2.0) * F.abs(yp - yt) / F.when(denom_s == 0, F.lit(1.0)).otherwise(denom_s)),
        "r2": r2,
    }


def _agg_list(y: str, p: str, whole: bool = False) -> list[Column]:
    """count + metrics; ``whole`` also fails on an input without rows."""
    n = F.count(F.lit(1))
    if whole:
        n = F.when(n == 0, F.raise_error(F.lit("no rows to evaluate")).cast("bigint")).otherwise(n)
    return [n.alias("n")] + [expr.alias(name) for name, expr in metric_exprs(y, p).items()]


def metrics_overall(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    """M8: one row: n + seven metrics, full precision. Missing values or no rows fail the job."""
    return df.agg(*_agg_list(y, p, whole=True))


def metrics_by(df: DataFrame, group_col: str, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    """One row per group with ``n`` and the seven metrics, fixed order."""
    return df.groupBy(group_col).agg(*_agg_list(y, p)).select(group_col, "n", *METRIC_NAMES)


def metrics_by_facility(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    return metrics_by(df, FACILITY, y, p)


def metrics_by_day(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    return metrics_by(df, SNAPSHOT_DAY, y, p)


def metrics_cube(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    """Overall + by facility + by day in ONE aggregation (grouping sets)."""
    g = df.groupingSets([[], [F.col(FACILITY)], [F.col(SNAPSHOT_DAY)]], FACILITY, SNAPSHOT_DAY)
    out = g.agg(F.grouping_id().alias("_gid"), *_agg_list(y, p))
    level = (F.when(F.col("_gid") == 3, F.lit("overall"))
             .when(F.col("_gid") == 1, F.lit("facility"))
             .otherwise(F.lit("snapshot_day")))
    return out.select(level.alias("level"), FACILITY, SNAPSHOT_DAY, "n", *METRIC_NAMES)


def null_count(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    """Rows where y or prediction is NULL/NaN (the reference raises on these)."""
    bad = F.col(y).isNull() | F.col(p).isNull() | F.isnan(y) | F.isnan(p)
    return df.agg(F.count_if(bad).alias("n_null"), F.count(F.lit(1)).alias("n"))


def assert_scorable(df: DataFrame, y: str = TARGET, p: str = PREDICTION) -> None:
    """Driver-side guard mirroring the reference: empty or null input raises."""
    row = null_count(df, y, p).first()
    if row["n"] == 0:
        raise ValueError("no rows to evaluate")
    if row["n_null"]:
        raise ValueError(f"{row['n_null']} rows have a missing actual or prediction")


def interval_coverage(df: DataFrame, y: str = TARGET, lower: str = "prediction_lower",
                      upper: str = "prediction_upper", group_col: str | None = None) -> DataFrame:
    """Share of actuals inside [lower, upper]."""
    inside = F.avg((F.col(y).between(F.col(lower), F.col(upper))).cast("double")).alias("coverage")
    n = F.count(F.lit(1)).alias("n")
    return df.groupBy(group_col).agg(n, inside) if group_col else df.agg(n, inside)
