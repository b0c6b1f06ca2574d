"""Model explanation as Spark jobs.

X1 permutation importance: a keyed bijection of the row numbers (a Feistel
network with cycle walking) names by arithmetic the row that each value moves
to, for every (feature, repeat); no sort. All permuted rows are scored by ONE
``transform``, and R^2 comes from grouped sufficient sums.

X3 global SHAP: exact Shapley values of tree ensembles, from the paths of the
flattened trees (``tree_shapley``). Other models: permutation sampling (the
public Shapley sampling estimator); windows are partitioned by (row,
permutation), so no window partition grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closecast.operators.boosting import Trees, flat_trees
from closecast.schema import KEYS, PREDICTION, TARGET


def dense_index(df: DataFrame, col: str = "_i") -> DataFrame:
    """0..n-1 row index without a single-partition window.

    Per-partition row counts (one small row per partition) give offsets; the
    index is offset + position inside the partition. The input must be
    checkpointed first, so recomputation after an executor loss cannot
    reorder rows and the index stays stable.
    """
    tagged = (df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))  # reliable: the index survives executor loss
    counts = tagged.groupBy("_pid").count()  # one row per partition
    offsets = counts.select("_pid", (F.sum("count").over(Window.orderBy("_pid")) - F.col("count")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return tagged.join(F.broadcast(offsets), "_pid").withColumn(col, (F.col("_off") + local).cast("long")).drop("_pid", "_mid", "_off")


def _r2_parts(df: DataFrame, group: list[str], y: str = TARGET, p: str = PREDICTION) -> DataFrame:
    err = F.col(y) - F.col(p)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(F.col(y) * F.col(y)).alias("syy"),
        F.sum(err * err).alias("sse"))


def _r2(parts: DataFrame) -> F.Column:
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return F.when(sst <= 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(F.lit(1.0) - F.col("sse") / sst)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shuffled(i: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """A bijection of 0..n-1 chosen by ``key``: a Feistel network on the next even power of two, walked until it is inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    out = i.astype(np.uint64)
    outside = np.arange(len(out))
    while len(outside):
        left, right = out[outside] >> width, out[outside] & mask
        for r in range(rounds):
            left, right = right, left ^ (_mixed(right, (key * 0x100000001B3 + r + 1) % (1 << 64)) & mask)
        out[outside] = (left << width) | right
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def permutation_importance(regressor, data: DataFrame, feature_names: list[str], n_repeats: int = 5,
                           seed: int = 42, y: str = TARGET) -> DataFrame:
    """Mean / std (population) of the R^2 drop when one feature is shuffled.

    ``data`` holds one column per feature name plus the target; ``regressor``
    is a fitted Spark ML model reading a ``features`` vector. Each row sends one
    value per (feature, repeat) to the row that ``shuffled`` names, in one shuffle.
    """
    spark = data.sparkSession
    assembler = VectorAssembler(inputCols=feature_names, outputCol="features", handleInvalid="keep")
    base = dense_index(assembler.transform(data.select(*feature_names, y)).select(vector_to_array("features").alias("x"), F.col(y).alias(y))).persist()
    n, k = base.count(), len(feature_names) * n_repeats

    def score(df):
        return regressor.transform(df.select("*", array_to_vector("x").alias("features")))

    base_parts = _r2_parts(score(base), [])
    first = base_parts.select(_r2(base_parts).alias("r2")).first()  # one scalar
    r2_base = first["r2"]

    @F.arrow_udf("array<bigint>")
    def goes_to(i: pa.Array) -> pa.Array:
        rows = i.to_numpy(zero_copy_only=False)
        to = np.stack([shuffled(rows, n, seed * 1_000_003 + j) for j in range(k)], axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(to.ravel()))

    sent = base.select("x", goes_to("_i").alias("to")).select(F.inline(F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.struct(j.alias("j"), F.get("to", j).alias("_i"), F.get("x", F.floor(j / n_repeats).cast("int")).alias("v")))))
    given = sent.groupBy("_i").agg(F.collect_list(F.struct("j", "v")).alias("given"))  # features x repeats values a row
    swapped = base.join(given, "_i").select("x", y, F.inline("given")).withColumn("f", F.floor(F.col("j") / n_repeats).cast("int"))
    swapped = swapped.select("f", "j", y, F.transform("x", lambda v, p: F.when(p == F.col("f"), F.col("v")).otherwise(v)).alias("x"))
    parts = _r2_parts(score(swapped), ["f", "j"])
    drop = F.lit(r2_base).cast("double") - _r2(parts)
    names = F.array(*[F.lit(c) for c in feature_names])
    out = (parts.select(F.get(names, F.col("f")).alias("feature"), drop.alias("drop")).groupBy("feature")
           .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
           .orderBy(F.col("importance_mean").desc(), "feature"))
    rows = out.collect()  # one row per feature
    base.unpersist()
    return spark.createDataFrame(rows, out.schema)


def native_importance(regressor, feature_names: list[str]) -> DataFrame | None:
    """The model's own importances (tree ensembles), else None."""
    imp = getattr(regressor, "featureImportances", None)
    if imp is None:
        return None
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = [(n, float(v)) for n, v in zip(feature_names, imp.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


class _Paths:
    """The paths of one tree to its leaves: per leaf its features, the range of each, and what each adds for every
    pattern of ranges that a row can be in."""

    def __init__(self, trees: Trees, t: int):
        self.leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        left, right, feature, threshold, cover, value = (getattr(trees, c)[t] for c in ("left", "right", "feature", "threshold", "cover", "value"))
        todo: list[tuple[int, dict]] = [(0, {})]
        while todo:
            node, path = todo.pop()
            if left[node] < 0:
                if path and value[node] != 0:
                    self._leaf(path, float(value[node]))
                continue
            f = int(feature[node])
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, ends in ((left[node], (low, min(high, threshold[node]))), (right[node], (max(low, threshold[node]), high))):
                todo.append((int(child), {**path, f: (*ends, share * cover[child] / cover[node])}))

    def _leaf(self, path: dict, value: float) -> None:
        m = len(path)
        low, high, share = (np.array(c) for c in zip(*path.values(), strict=True))
        inside = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1  # pattern x feature: is the row in the feature's range
        added = np.empty((1 << m, m))
        weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
        for j in range(m):
            # coefficients of the product over the other features of (share + inside * t), t counting those that are known
            poly = np.zeros((1 << m, m))
            poly[:, 0] = 1
            for k in range(m):
                if k != j:
                    up = np.zeros_like(poly)
                    up[:, 1:] = poly[:, :-1] * inside[:, k:k + 1]
                    poly = poly * share[k] + up
            added[:, j] = value * (poly @ weight) * (inside[:, j] - share[j])
        self.leaves.append((np.array(list(path), dtype=np.int64), low, high, added))


def tree_shapley(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Exact Shapley values (rows x features) of the trees' prediction.

    The value of a set of known features is the expectation of a tree where a
    split on an unknown feature sends a row both ways by the training rows'
    shares. For one leaf that is its value times a product over the path's
    features, so its Shapley values follow in closed form from which of the
    path's ranges hold the row; they are tabulated per leaf and looked up.
    The values of a row add up to its prediction less the expectation.
    """
    out = np.zeros(x.shape)
    for t in range(len(trees)):
        for features, low, high, added in _Paths(trees, t).leaves:
            v = x[:, features]
            pattern = ((v > low) & (v <= high)) @ (1 << np.arange(len(features)))
            out[:, features] += added[pattern]
    return out


def expected_prediction(trees: Trees) -> float:
    """The trees' prediction with no feature known."""
    total = trees.base
    for t in range(len(trees)):
        leaf = (trees.left[t] < 0) & (trees.cover[t] > 0)
        total += float((trees.value[t][leaf] * trees.cover[t][leaf]).sum() / trees.cover[t][0])
    return total


def _exact_shap(trees: Trees, rows: DataFrame, feature_names: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(trees)  # the model: trees x nodes, whatever the rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                sums = np.abs(tree_shapley(shared.value, x)).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(np.full(len(sums), batch.num_rows)), pa.array(sums)], names=["f", "n", "total"])

    names = F.array(*[F.lit(c) for c in feature_names])
    sums = rows.mapInArrow(run, "f int, n long, total double").groupBy("f").agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))
    return sums.select(F.get(names, F.col("f")).alias("feature"), "mean_abs_shap").orderBy(F.col("mean_abs_shap").desc(), "feature")


def shap_global(regressor, data: DataFrame, feature_names: list[str], max_samples: int | None = None,
                n_permutations: int = 10, seed: int = 42, top: int | None = None) -> DataFrame:
    """Mean |Shapley value| per feature over all rows. ``max_samples`` takes about that many rows, by key hash.

    Tree ensembles: exact, by ``tree_shapley``. Other models: by ``n_permutations``
    sampled orders a row, with the same rows as background."""
    spark = data.sparkSession
    nf = len(feature_names)
    order_cols = [k for k in KEYS if k in data.columns]
    sample = data
    if max_samples is not None:
        share = min(1.0, max_samples / max(1, data.count()))
        sample = data.where(F.pmod(F.xxhash64(F.lit(seed), *(order_cols or feature_names)), F.lit(1 << 20)) < int(share * (1 << 20)))
    vec = VectorAssembler(inputCols=feature_names, outputCol="_v", handleInvalid="keep")
    trees = flat_trees(regressor)
    if trees is not None:
        # as many tasks as cores where there are rows for them: a row takes time in the number of leaves
        arrays = vec.transform(sample).select(vector_to_array("_v").alias("x")).repartition(spark.sparkContext.defaultParallelism)
        rows = _exact_shap(trees, arrays, feature_names).limit(top or nf).collect()  # one row per feature
        return spark.createDataFrame(rows, "feature string, mean_abs_shap double")
    s = dense_index(vec.transform(sample).select(vector_to_array("_v").alias("x"))).persist()
    n = s.count()
    perms = s.select("_i", "x", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))).alias("m"))
    # feature order: sort feature positions by a seeded hash of (row, permutation, position)
    pos = F.sequence(F.lit(0), F.lit(nf - 1))
    keyed = F.transform(pos, lambda j: F.struct(F.xxhash64(F.lit(seed), F.col("_i"), F.col("m"), j).alias("h"),
                                                 j.alias("j")))
    perms = perms.withColumn("order", F.transform(F.array_sort(keyed), lambda t: t["j"]))
    perms = perms.withColumn("_bg", F.pmod(F.xxhash64(F.lit(seed + 1), "_i", "m"), F.lit(n)))
    bg = s.select(F.col("_i").alias("_bg"), F.col("x").alias("z"))
    perms = perms.join(bg, "_bg")
    # rank[j] = position of feature j in the order
    perms = perms.withColumn("rank", F.transform(pos, lambda j: F.array_position("order", j) - 1))
    steps = perms.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(nf))))
    mixed = F.transform(pos, lambda j: F.when(F.col("rank")[j] < F.col("k"), F.col("x")[j]).otherwise(F.col("z")[j]))
    steps = steps.withColumn("features", array_to_vector(mixed))
    pred = regressor.transform(steps).select("_i", "m", "k", "order", F.col(regressor.getPredictionCol()).alias("p"))
    w = Window.partitionBy("_i", "m").orderBy("k")
    delta = pred.withColumn("d", F.col("p") - F.lag("p", 1).over(w)).where("k > 0")
    delta = delta.withColumn("f", F.col("order")[F.col("k") - 1])
    phi = delta.groupBy("_i", "f").agg(F.avg("d").alias("phi"))
    names = F.array(*[F.lit(n) for n in feature_names])
    out = phi.groupBy("f").agg(F.avg(F.abs("phi")).alias("mean_abs_shap")).select(
        names[F.col("f")].alias("feature"), "mean_abs_shap").orderBy(F.col("mean_abs_shap").desc(), "feature")
    rows = out.collect()  # one row per feature
    s.unpersist()
    result = spark.createDataFrame(rows, out.schema)
    return result.limit(top) if top else result
