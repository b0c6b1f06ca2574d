import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from closecast.operators import explain as X
from closecast.operators import scoring as B
from closecast.operators.models import ScaledElasticNet, build_estimator, supported_models
from closecast.schema import PREDICTION, TARGET


def test_supported_and_unknown():
    assert set(supported_models()) == {"naive_prior", "seasonal_naive", "elastic_net", "gradient_boosting",
                                       "hist_gradient_boosting", "random_forest", "xgboost"}
    with pytest.raises(ValueError):
        build_estimator("nope")


def _linear_data(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 3.0 * x[:, 0] - 2.0 * x[:, 1] + 0.1 * rng.normal(size=n) + 50.0
    rows = [(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)]
    df = spark.createDataFrame(rows, f"x0 double, x1 double, x2 double, {TARGET} double")
    return x, y, VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)


def test_ridge_conversion_matches_closed_form(spark):
    """l1_ratio = 0: the converted penalty reproduces the published ridge objective
    (1/(2n))||y - Xw - b||^2 + (alpha/2)||w||^2 on standardized features."""
    x, y, df = _linear_data(spark)
    alpha = 0.5
    model = ScaledElasticNet(alpha=alpha, l1_ratio=0.0).fit(df)
    pred = np.array([r[PREDICTION] for r in model.transform(df).select(PREDICTION).collect()])
    n = len(y)
    xs = (x - x.mean(0)) / x.std(0, ddof=1)
    yc = y - y.mean()
    w = np.linalg.solve(xs.T @ xs / n + alpha * np.eye(3), xs.T @ yc / n)
    expect = xs @ w + y.mean()
    assert np.max(np.abs(pred - expect)) < 0.01 * y.std()


def test_permutation_importance_finds_planted_signal(spark):
    _, _, df = _linear_data(spark, n=300)
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol=PREDICTION, maxIter=15, maxDepth=3,
                       seed=1).fit(df)
    imp = X.permutation_importance(gbt, df.select("x0", "x1", "x2", TARGET), ["x0", "x1", "x2"], n_repeats=3)
    rows = imp.collect()
    assert rows[0]["feature"] == "x0" and rows[-1]["feature"] == "x2"
    assert rows[0]["importance_mean"] > 0.3
    native = X.native_importance(gbt, ["x0", "x1", "x2"]).first()
    assert native["feature"] == "x0"
    shap = X.shap_global(gbt, df.select("x0", "x1", "x2"), ["x0", "x1", "x2"], max_samples=60, n_permutations=4)
    assert shap.first()["feature"] == "x0"


def test_dense_index_is_a_permutation_of_0_to_n(spark):
    df = spark.range(0, 1000, numPartitions=7)
    idx = X.dense_index(df)
    got = sorted(r["_i"] for r in idx.select("_i").collect())
    assert got == list(range(1000))


def test_bundle_save_load_score(spark, snaps, tmp_path):
    from closecast.plans.common import naive_bundle

    bundle = naive_bundle(spark, "/root/testdata/sf0.001", run_id="r1")
    path = str(tmp_path / "bundle")
    B.save_bundle(bundle, path)
    loaded = B.load_bundle(path)
    assert loaded.model_name == "naive_prior" and loaded.run_id == "r1"
    a = B.batch_score(bundle, snaps, scored_at="2001-01-01 00:00:00")
    b = B.batch_score(loaded, snaps.drop(TARGET), scored_at="2001-01-01 00:00:00")
    assert a.exceptAll(b).isEmpty()
    assert b.where(F.col(PREDICTION).isNull()).isEmpty()
    assert set(b.columns) >= {"model_name", "model_version", "run_id", "cutoff_day", "scored_at"}


def test_cutoff_stamps_only(spark, snaps):
    from closecast.plans.common import naive_bundle

    out = B.batch_score(naive_bundle(spark, "/root/testdata/sf0.001"), snaps, cutoff_day=15)
    assert out.count() == snaps.count()
    assert [r[0] for r in out.select("cutoff_day").distinct().collect()] == [15]
