"""Snapshot and prediction readers / writers.

Readers always apply the declared schema (never infer: ``YYYY-MM`` strings
must stay strings). Writers produce directories, partitioned where the data
has a natural month key; a write replaces the whole set or, on request, only
the months it holds.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.schema import ALL_COLUMNS, KEYS, MONTH, TARGET, snapshot_schema
from closecast.session import ensure_checkpoint_dir

PARQUET_SUFFIXES = (".parquet", ".pq")
CSV_SUFFIXES = (".csv",)


def _format_of(path: str) -> str:
    lower = path.rstrip("/").lower()
    if lower.endswith(PARQUET_SUFFIXES):
        return "parquet"
    if lower.endswith(CSV_SUFFIXES):
        return "csv"
    raise ValueError(f"Unsupported dataset format for {path!r}: use .parquet, .pq or .csv")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the session's (shared) checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "closecast", f"{name}-{uuid.uuid4().hex[:12]}.parquet")


def read_snapshots(spark: SparkSession, path: str, with_target: bool = True) -> DataFrame:
    """A1: read Parquet / CSV by suffix with the declared schema, canonical order."""
    fmt = _format_of(path)
    schema = snapshot_schema(with_target)
    reader = spark.read.schema(schema)
    df = reader.parquet(path) if fmt == "parquet" else reader.option("header", True).csv(path)
    return df.select(*[c for c in ALL_COLUMNS if c in df.columns])


def missing_source_columns(spark: SparkSession, path: str, with_target: bool = True) -> list[str]:
    """C1d: declared columns that the files at ``path`` do not have (a declared read schema would fill them with NULL)."""
    reader = spark.read.option("header", True)
    present = set((reader.parquet(path) if _format_of(path) == "parquet" else reader.csv(path)).columns)
    return [f.name for f in snapshot_schema(with_target).fields if f.name not in present]


def write_snapshots(df: DataFrame, path: str, partition_by: str | None = MONTH, mode: str = "replace") -> str:
    """A2: write by suffix, Parquet partitioned by month.

    ``mode="replace"`` leaves exactly the rows of ``df``; ``mode="replace_months"``
    replaces the months that ``df`` holds and keeps the others.
    """
    fmt = _format_of(path)
    if mode not in ("replace", "replace_months"):
        raise ValueError(f"mode {mode!r}: replace or replace_months")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
    if partition_by and partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", True).csv(path)
    return path


def lake_uri(relative: str, lake_root: str | None = None, local_root: str | None = None) -> str:
    """A3/A4 path rule: a configured lake root wins, else a local root."""
    root = lake_root or local_root
    if not root:
        raise ValueError("no lake root and no local root configured")
    return relative if "://" in relative else os.path.join(root, relative.lstrip("/"))


def write_predictions(predictions: DataFrame, root: str, filename: str = "predictions.parquet") -> str:
    """A5: predictions sink for BI, partitioned by month and cutoff day.

    Dynamic partition overwrite makes a re-run of one checkpoint idempotent.
    """
    path = os.path.join(root, filename)
    parts = [c for c in (MONTH, "cutoff_day") if c in predictions.columns]
    (predictions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV report sink (a directory with a header per part)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json_row(df: DataFrame, path: str) -> str:
    """One-row JSON report (e.g. overall metrics)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def dataset_sample(snapshots: DataFrame, n: int = 50) -> DataFrame:
    """First n rows in key order, n clamped to 1..500."""
    n = max(1, min(int(n), 500))
    return snapshots.orderBy(*KEYS).limit(n)


def invalid_sample(snapshots: DataFrame, n: int = 20) -> DataFrame:
    """A10: first n rows in key order with three planted faults.

    Row 1 gets a malformed facility id, row 2 a negative target (only when the
    target column exists), row 3 an out-of-range snapshot day.
    """
    from pyspark.sql import Window

    w = Window.orderBy(*KEYS)
    head = snapshots.orderBy(*KEYS).limit(n).withColumn("_rn", F.row_number().over(w))
    cols = []
    for c in snapshots.columns:
        if c == "facility_id":
            cols.append(F.when(F.col("_rn") == 1, F.lit("FACILITY_1")).otherwise(F.col(c)).alias(c))
        elif c == TARGET:
            cols.append(F.when(F.col("_rn") == 2, F.lit(-1000.0)).otherwise(F.col(c)).alias(c))
        elif c == "snapshot_day":
            cols.append(F.when(F.col("_rn") == 3, F.lit(99).cast("bigint")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return head.select(*cols)


def read_lake(spark: SparkSession, relative: str, lake_root: str | None = None, local_root: str | None = None) -> DataFrame:
    """A3: Parquet from the lake (or the local fallback root)."""
    return spark.read.parquet(lake_uri(relative, lake_root, local_root))


def write_lake(df: DataFrame, relative: str, lake_root: str | None = None, local_root: str | None = None) -> str:
    """A4: Parquet to the lake (or the local fallback root); returns the location."""
    uri = lake_uri(relative, lake_root, local_root)
    df.write.mode("overwrite").parquet(uri)
    return uri


def materialise_default_datasets(snapshots: DataFrame, root: str, sample_rows: int = 200) -> dict[str, str]:
    """Full Parquet table, a first-``sample_rows`` CSV sample and the
    planted-fault CSV, written under ``root``."""
    full = os.path.join(root, "revenue_snapshots.parquet")
    sample = os.path.join(root, "revenue_snapshots_sample.csv")
    invalid = os.path.join(root, "revenue_snapshots_invalid.csv")
    write_snapshots(snapshots, full)
    snapshots.orderBy(*KEYS).limit(sample_rows).coalesce(1).write.mode("overwrite").option("header", True).csv(sample)
    invalid_sample(snapshots).coalesce(1).write.mode("overwrite").option("header", True).csv(invalid)
    return {"full": full, "sample": sample, "invalid": invalid}
