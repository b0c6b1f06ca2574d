import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from closecast.operators import profiling as PR
from closecast.operators.joins import bounded_broadcast
from closecast.operators.models import ModelConfig, build_estimator, fit_features, interval_columns
from closecast.operators.splits import blocked_temporal_split
from closecast.schema import PREDICTION, TARGET


def test_bounded_broadcast_only_below_bound(spark):
    small = spark.range(10)
    assert bounded_broadcast(small, max_bytes=5) is small          # above the bound: no hint
    hinted = bounded_broadcast(small, max_bytes=1000)
    assert hinted is not small and "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()


def test_facility_filter_unknown_raises(snaps):
    fac = snaps.agg(F.min("facility_id")).first()[0]
    assert PR.facility_rows(snaps, fac).count() > 0
    with pytest.raises(KeyError):
        PR.facility_rows(snaps, "FAC-999")
    series = PR.facility_month_series(snaps, facility=fac)
    assert [r[0] for r in series.select("facility_id").distinct().collect()] == [fac]


def test_every_learned_candidate_fits_and_scores(spark, snaps):
    """Wiring check with small iteration counts (the defaults are exercised
    by the registered training queries)."""
    split = blocked_temporal_split(snaps.where(F.col(TARGET) > 0))
    cache = fit_features(split)
    cfg = ModelConfig(gbr_params={"n_estimators": 3, "max_depth": 3, "learning_rate": 0.05, "subsample": 0.9},
                      hgb_params={"max_iter": 3, "learning_rate": 0.05, "max_depth": 4},
                      xgboost_params={"n_estimators": 3, "max_depth": 3, "learning_rate": 0.05, "subsample": 0.9,
                                      "colsample_bytree": 0.9, "reg_lambda": 1.0},
                      rf_params={"n_estimators": 4, "max_depth": 4})
    for name in ["elastic_net", "gradient_boosting", "hist_gradient_boosting", "random_forest", "xgboost"]:
        model = build_estimator(name, cfg).fit(cache.train)
        out = model.transform(cache.test)
        assert out.where(F.col(PREDICTION).isNull()).isEmpty(), name
        assert out.count() == split.test.count()
    rf = build_estimator("random_forest", cfg).fit(cache.train)
    scored, cols = interval_columns(rf.transform(cache.test), rf)
    row = scored.select(*cols, PREDICTION).first()
    assert row["prediction_std"] >= 0 and row["prediction_lower"] <= row[PREDICTION] <= row["prediction_upper"]
    assert isinstance(PipelineModel(stages=[cache.model, rf]), PipelineModel)


def test_checkpoint_dir_is_read_from_the_session(spark):
    from closecast.session import ensure_checkpoint_dir

    current = spark.sparkContext.getCheckpointDir()
    assert current  # set once (scratch dir in tests)
    assert ensure_checkpoint_dir(spark) == current  # never replaced once configured


def test_dense_index_survives_recomputation(spark):
    from closecast.operators.explain import dense_index

    idx = dense_index(spark.range(0, 500, numPartitions=5).withColumn("v", F.col("id") * 2))
    first = {r["id"]: r["_i"] for r in idx.collect()}
    again = {r["id"]: r["_i"] for r in idx.collect()}
    assert first == again and sorted(first.values()) == list(range(500))
