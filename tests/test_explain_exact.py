"""Intervals, Shapley values and permutations against slow versions."""
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from closecast.operators import boosting as B
from closecast.operators import explain as X
from closecast.operators.models import interval_columns
from closecast.schema import PREDICTION, TARGET


def frame(spark, n=300, wide=6, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, wide)).round(2)
    y = 2 * x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * np.abs(x[:, 3])
    rows = [(v.tolist(), float(t), *map(float, v)) for v, t in zip(x, y)]
    names = [f"x{j}" for j in range(wide)]
    schema = f"a array<double>, {TARGET} double, " + ", ".join(f"{c} double" for c in names)
    return x, names, spark.createDataFrame(rows, schema).repartition(3).withColumn("features", array_to_vector("a")).cache()


def by_subsets(trees, row):
    """Shapley values from the value of every subset of features."""
    def value(known, t, node):
        if trees.left[t, node] < 0:
            return trees.value[t, node]
        l, r = trees.left[t, node], trees.right[t, node]
        if trees.feature[t, node] in known:
            return value(known, t, l if row[trees.feature[t, node]] <= trees.threshold[t, node] else r)
        return sum(trees.cover[t, c] / trees.cover[t, node] * value(known, t, c) for c in (l, r))
    m = len(row)
    v = {s: sum(value(set(s), t, 0) for t in range(len(trees))) for k in range(m + 1) for s in combinations(range(m), k)}
    phi = np.zeros(m)
    for j in range(m):
        others = [k for k in range(m) if k != j]
        for k in range(m):
            for s in combinations(others, k):
                phi[j] += factorial(k) * factorial(m - 1 - k) / factorial(m) * (v[tuple(sorted((*s, j)))] - v[s])
    return phi, v[()] + trees.base


@pytest.mark.parametrize("kind", ["boosting", "gbt", "forest"])
def test_shapley_values_equal_enumeration(spark, kind):
    x, _, df = frame(spark)
    common = dict(featuresCol="features", labelCol=TARGET, predictionCol=PREDICTION, seed=3)
    model = {"boosting": lambda: B.HistogramBoosting(B.Boosting(6, 4, 0.3, max_leaves=9)), "gbt": lambda: GBTRegressor(maxIter=4, maxDepth=4, **common),
             "forest": lambda: RandomForestRegressor(numTrees=4, maxDepth=5, **common)}[kind]().fit(df)
    trees = B.flat_trees(model)
    got = X.tree_shapley(trees, x[:15])
    for k in range(15):
        phi, empty = by_subsets(trees, x[k])
        assert np.allclose(got[k], phi, atol=1e-10)
        assert empty == pytest.approx(X.expected_prediction(trees))
    pred = {tuple(r["a"]): r[PREDICTION] for r in model.transform(df).select("a", PREDICTION).collect()}
    assert np.allclose(trees.predict(x), [pred[tuple(v)] for v in x])
    assert np.allclose(X.tree_shapley(trees, x).sum(axis=1) + X.expected_prediction(trees), trees.predict(x))


def test_global_shap_is_the_mean_over_all_rows(spark):
    x, names, df = frame(spark)
    model = B.HistogramBoosting(B.Boosting(8, 3, 0.3)).fit(df)
    want = np.abs(X.tree_shapley(model.trees, x)).mean(axis=0)
    got = {r["feature"]: r["mean_abs_shap"] for r in X.shap_global(model, df, names).collect()}
    assert all(got[c] == pytest.approx(w) for c, w in zip(names, want))
    assert [r["feature"] for r in X.shap_global(model, df, names, top=2).collect()] == sorted(names, key=lambda c: -got[c])[:2]


def test_interval_equals_the_members_spread(spark):
    _, _, df = frame(spark)
    forest = RandomForestRegressor(numTrees=7, maxDepth=6, featuresCol="features", labelCol=TARGET, predictionCol=PREDICTION, seed=1).fit(df)
    out, cols = interval_columns(forest.transform(df), forest)
    assert set(out.columns) == {*forest.transform(df).columns, "prediction_std"}
    got = {tuple(r["a"]): r for r in out.select("a", PREDICTION, *cols).collect()}
    rows = df.select("a", "features").collect()
    for r in rows[:60]:
        each = np.array([t.predict(r["features"]) for t in forest.trees])
        g = got[tuple(r["a"])]
        assert g["prediction_std"] == pytest.approx(each.std(), abs=1e-9) and g[PREDICTION] == pytest.approx(each.mean())
        assert g["prediction_upper"] - g["prediction_lower"] == pytest.approx(2 * 1.96 * each.std(), abs=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_shuffled_is_a_bijection_for_every_key(n):
    seen = set()
    for key in range(12):
        to = X.shuffled(np.arange(n), n, key)
        assert sorted(to.tolist()) == list(range(n))
        parts = np.concatenate([X.shuffled(np.arange(n)[k::3], n, key) for k in range(3)])
        assert sorted(parts.tolist()) == list(range(n)) and (X.shuffled(np.array([n - 1]), n, key) == to[n - 1]).all()
        seen.add(tuple(to.tolist()))
    if n >= 64:
        assert len(seen) == 12
        assert abs(np.corrcoef(np.arange(n), X.shuffled(np.arange(n), n, 77))[0, 1]) < 4 / np.sqrt(n)


def test_permutation_importance_equals_shuffling_by_hand(spark):
    x, names, df = frame(spark, 240)
    model = B.HistogramBoosting(B.Boosting(10, 3, 0.3)).fit(df)
    got = {r["feature"]: r for r in X.permutation_importance(model, df, names, n_repeats=3, seed=5).collect()}
    base = X.dense_index(df.select("a", TARGET)).orderBy("_i").collect()
    v, y = np.array([r["a"] for r in base]), np.array([r[TARGET] for r in base])
    r2 = lambda p: 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    for f, name in enumerate(names):
        drops = []
        for r in range(3):
            w = v.copy()
            w[X.shuffled(np.arange(len(v)), len(v), 5 * 1_000_003 + f * 3 + r), f] = v[:, f]
            drops.append(r2(model.trees.predict(v)) - r2(model.trees.predict(w)))
        assert got[name]["importance_mean"] == pytest.approx(np.mean(drops), abs=1e-9)
        assert got[name]["importance_std"] == pytest.approx(np.std(drops), abs=1e-9)
    assert max(got, key=lambda c: got[c]["importance_mean"]) == "x0"
