"""Access to the driver's source tables (one Parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Lazily read one table; selecting columns here lets the scan prune them."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread CPU-heavy per-row work over the cluster's cores.

    Only when the scan yields fewer input partitions than the default
    parallelism (e.g. one large row group) is a round-robin repartition added;
    on a big input the scan already has many more splits than cores and the
    frame is returned untouched (no extra shuffle).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
