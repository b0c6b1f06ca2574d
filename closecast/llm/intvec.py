"""Embeddings as integer vectors: floor(1024 * x) of every component, packed in binary columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 1024
#: Components beyond +-2^24 (|x| > 16384) saturate there: a product of vectors of up to 2^14 components then fits a long.
LIMIT = 1 << 24
_STEP = 1 << 14  # vectors converted at a time


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _STEP):
            batch = whole.slice(at, _STEP)
            lists = batch.column("__v")
            lists = lists.cast(pa.large_list(pa.float64()))
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            ends = np.cumsum(sizes)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null component reads as NaN
            ok = np.asarray(lists.is_valid()).copy()
            ok[np.searchsorted(ends, np.flatnonzero(~np.isfinite(flat)), side="right")] = False
            with np.errstate(over="ignore", invalid="ignore"):
                ints = np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT)
            ints = np.where(np.isfinite(ints), ints, 0).astype(np.int32)
            starts = ends - sizes
            square = np.append(ints.astype(np.float64) ** 2, 0.0)
            norm = np.sqrt(np.add.reduceat(square, starts)) if len(sizes) else np.zeros(0)
            norm = np.where(sizes > 0, norm, 0.0)
            keep = np.flatnonzero(ok)
            rows = batch.take(pa.array(keep)).drop_columns(["__v"])
            vecs = pa.array([ints[starts[i]:ends[i]].tobytes() for i in keep], pa.binary())
            extra = [pa.array(sizes[keep].astype(np.int32)), pa.array(norm[keep]), vecs]
            yield pa.RecordBatch.from_arrays([*rows.columns, *extra], names=[*rows.schema.names, "dim", "norm", "v"])


def integer_vectors(df: DataFrame, vector: str = "embedding", **keep: Column) -> DataFrame:
    """The columns ``keep`` with ``dim int, norm double, v binary`` (int32 components) of each usable vector.

    Rows whose vector is null or holds a null or non-finite component are left
    out. An empty vector has dim 0 and norm 0.
    """
    src = df.select(*[c.alias(k) for k, c in keep.items()], F.col(vector).cast("array<double>").alias("__v"))
    fields = [f for f in src.schema.fields if f.name != "__v"]
    return src.mapInArrow(_pack, T.StructType([*fields, T.StructField("dim", T.IntegerType()), T.StructField("norm", T.DoubleType()), T.StructField("v", T.BinaryType())]))
