"""Join helpers: size-checked broadcast, predictions vs actuals, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.schema import KEYS, TARGET

# Bytes above which a dimension is never hinted for broadcast; the planner (and
# AQE at runtime) then chooses a shuffle join, with skew-join splitting enabled.
BROADCAST_BYTE_LIMIT = 64 << 20


def row_bytes(df: DataFrame) -> int:
    """Bytes of one row as Spark holds it: 8 for a fixed-width column, 40 for any other, 16 for the row."""
    wide = ("string", "binary", "array", "map", "struct")
    return 16 + sum(40 if t.startswith(wide) else 8 for _, t in df.dtypes)


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Hint a broadcast only when the (already projected) side is proven small.

    The proof is one count, summed map-side, times the width of a row. Above
    the bound the frame is returned unhinted and Spark plans a shuffle join; the result is the same.
    """
    return F.broadcast(df) if df.count() * row_bytes(df) <= max_bytes else df


def predictions_vs_actuals(predictions: DataFrame, actuals: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Inner equi-join on the key columns both sides carry.

    A target already present on the prediction side is dropped first so the
    joined frame has exactly one target column. A key with more than one
    actual fails the job: it would double its predictions.
    """
    join_keys = keys or [k for k in KEYS if k in predictions.columns and k in actuals.columns]
    if not join_keys:
        raise ValueError("predictions and actuals share no key column")
    preds = predictions.drop(TARGET) if TARGET in predictions.columns else predictions
    n = F.count(F.lit(1))
    one = F.when(n > 1, F.raise_error(F.concat(F.lit("several actuals for key "), F.to_json(F.struct(*join_keys)))).cast("double")).otherwise(F.max(TARGET))
    return preds.join(actuals.groupBy(*join_keys).agg(one.alias(TARGET)), on=join_keys, how="inner")


def eval_coverage(predictions: DataFrame, actuals: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys predicted without an actual and actuals without a prediction."""
    join_keys = keys or [k for k in KEYS if k in predictions.columns and k in actuals.columns]
    p = predictions.select(*join_keys).distinct()
    a = actuals.select(*join_keys).distinct()
    missing_actual = p.join(a, join_keys, "left_anti").withColumn("gap", F.lit("prediction_without_actual"))
    missing_pred = a.join(p, join_keys, "left_anti").withColumn("gap", F.lit("actual_without_prediction"))
    return missing_actual.unionByName(missing_pred)

