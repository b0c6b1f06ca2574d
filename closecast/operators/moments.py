"""T5, L3: elastic nets of every backtest fold from one moment matrix a month.

A fold trains on a run of months, so its sums of products are sums of its months'.
Medians, and so imputed values, differ by fold; a row is therefore kept as
``(1, z, m, hot, y)``: z the numeric inputs as ``(x - shift) / scale`` and 0 where
missing, m their missing flags, hot the one-hot columns of all categories. An imputed
input is ``z + (median - shift) / scale * m``, a linear map of that row, so the moments
of a fold's features follow from the months' by two matrix products. Shift and scale
are the column's mean and deviation; they cancel out of every result and only
keep the sums well conditioned.

One pass over the rows adds the months' matrices up; exact medians of all folds take
their at most five counting passes together. The driver gets months x width rows of
width numbers (width about 100) whatever the rows. Rows whose target is null, NaN or
infinite teach nothing; so do those without a month. A fold without such training rows fails.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closecast.functions.columns import finite_or_null
from closecast.functions.quantiles import column_quantiles
from closecast.operators.baselines import BASELINE_FEATURES
from closecast.operators.features import LeakageSafeFeaturesModel, numeric_inputs, with_derived
from closecast.operators.metrics import METRIC_NAMES, metrics_by
from closecast.operators.splits import SplitConfig, expanding_fold_windows, ordered_months, rolling_fold_windows
from closecast.schema import DIMENSIONS, FEATURES, MONTH, PREDICTION, TARGET


@dataclass(frozen=True)
class MonthMoments:
    """``sums[month]`` is the month's sum of outer products of (1, z, m, hot, y)."""

    numeric: list[str]
    categories: dict[str, list[str]]
    shift: np.ndarray  # numeric inputs, then the target
    scale: np.ndarray
    sums: dict[str, np.ndarray]

    @property
    def hot_names(self) -> list[tuple[str, str]]:
        return [(d, c) for d, cats in self.categories.items() for c in cats]

    def over(self, months: list[str]) -> np.ndarray:
        found = [self.sums[m] for m in months if m in self.sums]
        if not found:
            raise ValueError("no training row with a finite target in this fold")
        return np.sum(found, axis=0)


def _month_products(width: int, n_numeric: int, hot: list[np.ndarray]):
    """Per task: month, row of the matrix and its numbers, added up over the task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.column_stack([batch.column(1 + j).to_numpy(zero_copy_only=False) for j in range(n_numeric + 1)])
            missing = np.isnan(z[:, :-1])
            dims = [batch.column(2 + n_numeric + d).to_numpy(zero_copy_only=False) for d in range(len(hot))]
            flags = [(values[:, None] == cats[None, :]) for values, cats in zip(dims, hot, strict=True)]
            rows = np.column_stack([np.ones(len(z)), np.where(missing, 0.0, z[:, :-1]), missing, *flags, z[:, -1]]).astype(np.float64)
            month = batch.column(0).to_numpy(zero_copy_only=False)
            for m in np.unique(month):
                part = rows[month == m]
                total[m] = total.get(m, 0.0) + part.T @ part
        for m, matrix in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([m] * width), pa.array(np.arange(width, dtype=np.int32)),
                                              pa.array(list(matrix), pa.list_(pa.float64()))], names=["month", "i", "v"])
    return run


def month_moments(df: DataFrame, label: str = TARGET) -> MonthMoments:
    """The months' moment matrices of the feature builder's inputs, one pass over the rows after one for means and categories."""
    keep = [c for c in FEATURES if c in df.columns]
    usable = with_derived(df.where(F.col(MONTH).isNotNull()).select(F.col(MONTH).cast("string").alias("_month"), finite_or_null(F.col(label).cast("double")).alias("_y"), *keep)).where("_y IS NOT NULL")
    numeric = numeric_inputs(keep)
    dims = [d for d in DIMENSIONS if d in df.columns]
    value: dict[str, Column] = {c: finite_or_null(F.col(f"`{c}`").try_cast("double")) for c in numeric} | {"_y": F.col("_y")}
    row = usable.agg(*[F.avg(v).alias(f"a{j}") for j, v in enumerate(value.values())], *[F.stddev_pop(v).alias(f"s{j}") for j, v in enumerate(value.values())],
                     *[F.array_sort(F.collect_set(F.col(d).cast("string"))).alias(f"c{j}") for j, d in enumerate(dims)]).first()
    shift = np.array([row[f"a{j}"] or 0.0 for j in range(len(value))])
    scale = np.array([row[f"s{j}"] or 1.0 for j in range(len(value))])
    categories = {d: list(row[f"c{j}"]) for j, d in enumerate(dims)}
    flat = usable.select("_month", *[((v - F.lit(float(shift[j]))) / F.lit(float(scale[j]))).alias(f"z{j}") for j, v in enumerate(value.values())],
                         *[F.col(d).cast("string").alias(f"d{j}") for j, d in enumerate(dims)])
    width = 2 + 2 * len(numeric) + sum(map(len, categories.values()))
    hot = [np.array(cats, dtype=object) for cats in categories.values()]
    parts = flat.mapInArrow(_month_products(width, len(numeric), hot), "month string, i int, v array<double>")
    rows = parts.groupBy("month", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()  # months x width rows
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        sums.setdefault(r["month"], np.zeros((width, width)))[r["i"]] = r["v"].toArray()
    return MonthMoments(numeric, categories, shift, scale, sums)


def fold_medians(df: DataFrame, folds: dict[object, list[str]]) -> dict[object, dict[str, float]]:
    """Exact medians of every numeric input over each fold's months; all folds share the counting passes. 0 where a fold has no value."""
    enriched = with_derived(df.select(MONTH, *[c for c in FEATURES if c in df.columns and c != MONTH]))
    numeric = numeric_inputs([c for c in enriched.columns if c in FEATURES])
    month = F.col(MONTH).cast("string")
    wanted = {(f, c): F.when(month.isin(months), finite_or_null(F.col(f"`{c}`").try_cast("double"))) for f, months in folds.items() for c in numeric}
    found = column_quantiles(enriched, wanted, [0.5])
    return {f: {c: found.get((f, c), [0.0])[0] for c in numeric} for f in folds}


def covariance_descent(a: np.ndarray, c: np.ndarray, l1: float, l2: float, max_sweeps: int = 10000, tol: float = 1e-10) -> np.ndarray:
    """argmin of w'Aw / 2 - c'w + l1 |w|_1 + l2 |w|^2 / 2 by cyclic coordinate descent on the kept gradient; stops when no weight moves by more than ``tol`` of the largest."""
    w, gradient = np.zeros(len(c)), c.astype(float).copy()
    for _ in range(max_sweeps):
        moved = 0.0
        for j in np.flatnonzero(a.diagonal() > 0):
            rho = gradient[j] + a[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (a[j, j] + l2)
            step = new - w[j]
            if step:
                gradient -= a[:, j] * step
                w[j] = new
                moved = max(moved, abs(step))
        if moved <= tol * max(np.abs(w).max(initial=0.0), 1e-300):
            break
    return w


@dataclass(frozen=True)
class FoldModel:
    """The fitted feature builder of a fold, the weights of its columns, the intercept and the mean target."""

    features: LeakageSafeFeaturesModel
    weights: np.ndarray
    intercept: float
    mean_target: float

    def prediction(self) -> Column:
        out = F.lit(float(self.intercept))
        for name, w in zip(self.features.feature_names(), self.weights, strict=True):
            out = out + F.col(f"`{name}`") * F.lit(float(w))
        return out


def fit_fold(moments: MonthMoments, months: list[str], medians: dict[str, float], alpha: float, l1_ratio: float, max_iter: int = 10000) -> FoldModel:
    """The elastic net of ``models.ScaledElasticNet`` on standardised features, from the sums of the fold's months alone."""
    g = moments.over(months)
    k, hot = len(moments.numeric), moments.hot_names
    n = g[0, 0]
    seen = [h for h in range(len(hot)) if g[1 + 2 * k + h, 0] > 0]  # a category of other months is no column of this fold
    to_features = np.zeros((len(g), 2 + k + len(seen)))
    to_features[0, 0] = to_features[-1, -1] = 1.0
    for j, name in enumerate(moments.numeric):
        to_features[1 + j, 1 + j] = 1.0
        to_features[1 + k + j, 1 + j] = (medians[name] - moments.shift[j]) / moments.scale[j]
    for at, h in enumerate(seen):
        to_features[1 + 2 * k + h, 1 + k + at] = 1.0
    means = (to_features.T @ g[:, 0] / n)[1:]
    cov = (to_features.T @ g @ to_features / n)[1:, 1:] - np.outer(means, means)
    sd = np.sqrt(np.maximum(cov.diagonal(), 0.0) * (n / max(n - 1, 1)))
    constant = sd[:-1] <= 1e-7 * np.maximum(1.0, np.abs(means[:-1]))  # what rounding leaves of a constant column
    inv = np.where(constant, 0.0, 1.0 / np.where(constant, 1.0, sd[:-1]))
    unit = float(moments.scale[-1])
    w = covariance_descent(cov[:-1, :-1] * np.outer(inv, inv), cov[:-1, -1] * inv * unit, alpha * l1_ratio, alpha * (1.0 - l1_ratio), max_iter)
    in_scale = np.concatenate([moments.scale[:-1], np.ones(len(seen))])
    in_shift = np.concatenate([moments.shift[:-1], np.zeros(len(seen))])
    weights = w * inv / in_scale
    mean_target = float(means[-1] * unit + moments.shift[-1])
    kept = [hot[h] for h in seen]
    stats = {"medians": {c: medians[c] for c in moments.numeric}, "categories": {d: [c for e, c in kept if e == d] for d in moments.categories}}
    features = LeakageSafeFeaturesModel()
    features._set(statsJson=json.dumps(stats), outputCol="")
    return FoldModel(features, weights, mean_target - float(weights @ (means[:-1] * in_scale + in_shift)), mean_target)


def backtest_linear(df: DataFrame, kinds: tuple[str, ...] = ("expanding", "rolling"), split_config: SplitConfig | None = None,
                    alpha: float = 0.5, l1_ratio: float = 0.3, max_iter: int = 10000) -> DataFrame:
    """T5: both baselines and the elastic net, fitted on every fold's training months and measured on its validation months.

    Rows: ``kind, fold_id, model, n`` and the seven metrics, from one aggregate over all folds' validation rows.
    """
    months = ordered_months(df)
    windows = {"expanding": expanding_fold_windows, "rolling": rolling_fold_windows}
    folds = {(kind, f): w for kind in kinds for f, w in enumerate(windows[kind](len(months), split_config))}
    train = {key: months[lo:hi] for key, (lo, hi, _, _) in folds.items()}
    moments, medians = month_moments(df), fold_medians(df, train)
    parts = []
    for (kind, f), (_, _, lo, hi) in folds.items():
        model = fit_fold(moments, train[kind, f], medians[kind, f], alpha, l1_ratio, max_iter)
        base = {name: F.coalesce(finite_or_null(F.col(c)), F.lit(model.mean_target)) for name, c in BASELINE_FEATURES.items()}
        rows = model.features.transform(df.where(F.col(MONTH).isin(months[lo:hi])).withColumns({f"_{n}": c for n, c in base.items()}))
        each = F.array(*[F.struct(F.lit(n).alias("model"), p.alias(PREDICTION)) for n, p in [*((n, F.col(f"_{n}")) for n in base), ("elastic_net", model.prediction())]])
        parts.append(rows.select(F.lit(kind).alias("kind"), F.lit(f).alias("fold_id"), TARGET, F.inline(each)))
    if not parts:
        raise ValueError("too few months for a fold")
    tagged = parts[0]
    for part in parts[1:]:
        tagged = tagged.unionByName(part)
    key = F.struct("kind", "fold_id", "model")
    return metrics_by(tagged.withColumn("_key", key), "_key").select("_key.*", "n", *METRIC_NAMES)
