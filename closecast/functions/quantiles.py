"""Exact linear-interpolated quantiles of many columns at once, by radix selection.

A double has a 64-bit image of the same order. A pass counts, per column, the
values by their next few bits, only among those that agree with a wanted
value in the bits known so far; the counts tell which cell holds each wanted
rank. A cell carries its smallest and largest image too, so a rank is known as
soon as its cell has one distinct value or the rank is the cell's first or last.
At most five passes over the columns; they shuffle counts, no values, and
return at most columns x ranks x 4096 cells (65,536 a column in the first)
to the driver, whatever the rows. Counts are added map-side, so a value that
fills a third of the rows is one cell per batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PASS_BITS = (16, 12, 12, 12, 12)
_SIGN = np.uint64(1 << 63)


def bin_of(x: Column, edges: Column, n: int) -> Column:
    """How many of the first ``n`` array elements are <= x (missing ones count 0); plain arithmetic, so it stays in codegen."""
    return reduce(lambda a, b: a + b, [F.coalesce((F.get(edges, F.lit(i)) <= x).cast("int"), F.lit(0)) for i in range(n)], F.lit(0))


def ordered_image(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; -0.0 as 0.0, NaN last."""
    x = np.where(np.isnan(x), np.nan, x + 0.0)
    bits = np.ascontiguousarray(x, dtype=np.float64).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def value_of(image: int) -> float:
    bits = image ^ (1 << 63) if image >> 63 else ~image & ((1 << 64) - 1)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _cell_counts(names: list[str], wanted: dict[int, np.ndarray] | None, known: int, bits: int):
    """Per batch: (column, cell, n, least, largest) among values whose first ``known`` bits are wanted; a cell is their first known + bits bits."""
    shift = np.uint64(64 - known - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for j in range(len(names)) if wanted is None else wanted:
                column = batch.column(j)
                image = ordered_image(column.drop_null().to_numpy(zero_copy_only=False))
                if wanted is not None:
                    prefix = image >> np.uint64(64 - known)
                    at = np.minimum(np.searchsorted(wanted[j], prefix), len(wanted[j]) - 1)
                    image = image[wanted[j][at] == prefix]
                if not len(image):
                    continue
                image.sort()
                cell = image >> shift
                first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
                last = np.append(first[1:], len(cell)) - 1
                out.append((np.full(len(first), j), cell[first].view(np.int64), last - first + 1, (image[first] ^ _SIGN).view(np.int64), (image[last] ^ _SIGN).view(np.int64)))
            if out:
                col, cell, n, least, largest = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(col.astype(np.int32)), pa.array(cell), pa.array(n), pa.array(least), pa.array(largest)], names=["col", "cell", "n", "least", "largest"])
    return run


def ranked_values(df: DataFrame, columns: dict[str, Column], ranks_of) -> dict[str, tuple[int, dict[int, float]]]:
    """Per column its number of values and the values of the wanted ranks (0-based), nulls left out.

    ``ranks_of(n)`` names the ranks of a column of n values.
    """
    names = list(columns)
    wide = df.select(*[c.cast("double").alias(f"c{j}") for j, c in enumerate(columns.values())])
    # per column: unknown ranks as (rank, prefix, rank within the prefix)
    open_ranks: dict[int, list[tuple[int, int, int]]] = {}
    found: dict[int, dict[int, float]] = {j: {} for j in range(len(names))}
    size = [0] * len(names)
    known, wanted = 0, None
    for bits in _PASS_BITS:
        counts = wide.mapInArrow(_cell_counts(names, wanted, known, bits), "col int, cell long, n long, least long, largest long")
        rows = counts.groupBy("col", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("largest").alias("largest")).toPandas()
        known += bits
        rows["image"] = rows["cell"].to_numpy().astype(np.int64).view(np.uint64)
        rows = rows.sort_values(["col", "image"])
        parts = {int(j): g for j, g in rows.groupby("col")}
        if wanted is None:
            for j, g in parts.items():
                size[j] = int(g["n"].sum())
                open_ranks[j] = [(r, 0, r) for r in sorted(set(ranks_of(size[j])))]
        wanted = {}
        for j, ranks in open_ranks.items():
            g = parts[j]
            image, n = g["image"].to_numpy(), g["n"].to_numpy()
            upto = np.cumsum(n)
            least, largest = (g[c].to_numpy().astype(np.int64).view(np.uint64) ^ _SIGN for c in ("least", "largest"))
            left = []
            for rank, prefix, inner in ranks:
                start = int(np.searchsorted(image >> np.uint64(bits), np.uint64(prefix), "left")) if known > bits else 0
                before = int(upto[start - 1]) if start else 0
                at = int(np.searchsorted(upto, before + inner, "right"))
                inside = before + inner - (int(upto[at - 1]) if at else 0)
                if inside == 0 or least[at] == largest[at]:
                    found[j][rank] = value_of(int(least[at]))
                elif inside == n[at] - 1:
                    found[j][rank] = value_of(int(largest[at]))
                else:
                    left.append((rank, int(image[at]), inside))
            open_ranks[j] = left
            if left:
                wanted[j] = np.unique(np.array([p for _, p, _ in left], dtype=np.uint64))
        open_ranks = {j: r for j, r in open_ranks.items() if r}
        if not open_ranks:
            break
    return {names[j]: (size[j], found[j]) for j in range(len(names))}


def column_quantiles(df: DataFrame, columns: dict[str, Column], levels: list[float], relative_error: float | None = None) -> dict[str, list[float]]:
    """The quantiles of every column, in the order of ``levels``; columns without values are left out.

    The value at position p = level * (n - 1) is interpolated between its two
    neighbours as (hi - p) * x[lo] + (p - lo) * x[hi]. ``relative_error``, if
    the caller gives one, returns a sketch's values instead.
    """
    if relative_error:
        levels_col = F.array(*[F.lit(q) for q in levels])
        row = df.agg(*[F.percentile_approx(c.cast("double"), levels_col, int(1.0 / relative_error)).alias(f"c{j}") for j, c in enumerate(columns.values())]).first()
        return {name: list(row[f"c{j}"]) for j, name in enumerate(columns) if row[f"c{j}"] is not None}
    places = lambda n: [q * (n - 1) for q in levels]
    got = ranked_values(df, columns, lambda n: [r for p in places(n) for r in (math.floor(p), math.ceil(p))] if n else [])
    out = {}
    for name, (n, value) in got.items():
        if n:
            pairs = [(p, value[math.floor(p)], value[math.ceil(p)]) for p in places(n)]
            out[name] = [lo if math.floor(p) == math.ceil(p) or lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi for p, lo, hi in pairs]
    return out


def quantile_table(df: DataFrame, columns: dict[str, Column], levels: list[float], relative_error: float | None = None) -> DataFrame:
    """(feature, q array<double>): a row per column with values."""
    found = column_quantiles(df, columns, levels, relative_error)
    return df.sparkSession.createDataFrame(list(found.items()), "feature string, q array<double>")


def exact_quantiles(long: DataFrame, levels: list[float], relative_error: float | None = None) -> DataFrame:
    """``quantile_table`` of a table (feature, x), one column per feature. The features are a short list, such as a model's inputs."""
    names = sorted(r["feature"] for r in long.select("feature").distinct().collect())
    return quantile_table(long, {f: F.when(F.col("feature") == f, F.col("x")) for f in names}, levels, relative_error)


def quantile(df: DataFrame, x: Column, level: float, relative_error: float | None = None) -> float | None:
    """One exact quantile of a column's non-null values; None where there are none."""
    return column_quantiles(df, {"x": x}, [level], relative_error).get("x", [None])[0]
