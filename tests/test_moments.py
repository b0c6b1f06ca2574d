"""Fold models from the months' moments: equal to a refit on the fold's own rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from closecast.operators.features import LeakageSafeFeatures
from closecast.operators.models import ModelConfig, build_estimator
from closecast.operators.moments import backtest_linear, covariance_descent, fit_fold, fold_medians, month_moments
from closecast.operators.splits import SplitConfig, ordered_months
from closecast.plans.training import backtest_candidates
from closecast.schema import MONTH, PREDICTION, TARGET


@pytest.fixture(scope="module")
def gappy(snaps):
    """Positive targets, with every seventh facility's payments missing, more of them in late months."""
    hole = (F.substring("facility_id", 5, 3).cast("int") % 7 == 0) | (F.col(MONTH) > "2000-06") & (F.col("snapshot_day") == 10)
    return snaps.where(F.col(TARGET) > 0).withColumn("month_to_date_payments", F.when(~hole, F.col("month_to_date_payments")))


def test_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) @ rng.normal(size=(8, 8))
    y = x[:, 0] * 3 - x[:, 3] + rng.normal(size=200)
    a, c = x.T @ x / 200, x.T @ y / 200
    w = covariance_descent(a, c, 0.5, 0.2)
    slack = c - a @ w - 0.2 * w
    assert np.allclose(slack[w != 0], 0.5 * np.sign(w[w != 0]), atol=1e-7)
    assert (np.abs(slack[w == 0]) <= 0.5 + 1e-7).all() and (w == 0).any()
    assert np.allclose(covariance_descent(a, c, 0.0, 0.0), np.linalg.solve(a, c), atol=1e-6)
    assert (covariance_descent(np.zeros((2, 2)), np.zeros(2), 0.1, 0.1) == 0).all()


def test_a_fold_equals_a_refit_on_its_rows(gappy):
    months = ordered_months(gappy)[12:30]
    rows = gappy.where(F.col(MONTH).isin(months))
    medians = fold_medians(gappy, {"f": months, "g": months[:3]})
    builder = LeakageSafeFeatures(outputCol="features").fit(rows)
    assert medians["f"] == pytest.approx(builder.medians) and medians["g"] != medians["f"]
    model = fit_fold(month_moments(gappy), months, medians["f"], 0.5, 0.3)
    assert model.features.feature_names() == builder.feature_names()

    frame = builder.transform(rows).toPandas()
    x, y = np.stack([v.toArray() for v in frame["features"]]), frame[TARGET].to_numpy()
    mean, sd = x.mean(axis=0), x.std(axis=0, ddof=1)
    u = np.where(sd > 1e-9 * np.maximum(1, np.abs(mean)), (x - mean) / np.where(sd > 0, sd, 1), 0.0)
    w = covariance_descent(u.T @ u / len(u), u.T @ (y - y.mean()) / len(u), 0.15, 0.35)
    plain = y.mean() + u @ w
    mine = model.intercept + x @ model.weights
    assert model.mean_target == pytest.approx(y.mean())
    assert np.abs(mine - plain).max() <= 1e-6 * np.abs(y).mean()

    spark_fit = build_estimator("elastic_net", ModelConfig()).fit(builder.transform(rows))
    theirs = spark_fit.transform(builder.transform(rows)).select("facility_id", MONTH, "snapshot_day", PREDICTION)
    ours = model.features.transform(rows).select("facility_id", MONTH, "snapshot_day", model.prediction().alias("p"))
    gap = ours.join(theirs, ["facility_id", MONTH, "snapshot_day"]).agg(F.max(F.abs(F.col("p") - F.col(PREDICTION))), F.avg(F.abs(PREDICTION)), F.count("*")).first()
    assert gap[2] == rows.count() and gap[0] <= 5e-3 * gap[1]


def test_bad_targets_teach_nothing_and_folds_without_rows_fail(gappy):
    months = ordered_months(gappy)
    spoiled = gappy.withColumn(TARGET, F.when(F.col(MONTH) == months[0], F.lit(float("nan"))).when(F.col(MONTH) != months[1], F.col(TARGET)))
    got = month_moments(spoiled)
    assert set(got.sums) == set(months[2:])
    with pytest.raises(ValueError):
        got.over(months[:2])


def test_the_backtest_covers_every_fold_and_model(gappy):
    got = backtest_linear(gappy, split_config=SplitConfig(n_backtest_folds=2)).toPandas()
    assert sorted(got.groupby(["kind", "fold_id"]).size()) == [3] * 4
    wape = got.pivot_table(index=["kind", "fold_id"], columns="model", values="wape")
    assert (wape["elastic_net"] < wape["seasonal_naive"]).all()
    by_fits = backtest_candidates(gappy, ["naive_prior", "elastic_net"], "rolling", SplitConfig(n_backtest_folds=2)).toPandas()
    for r in by_fits.itertuples():
        assert r.wape == pytest.approx(wape.loc[("rolling", r.fold_id), r.model], rel=1e-2)
    assert len(by_fits) == 4
