import math

import pytest

from closecast.operators import kpi as K
from closecast.operators import metrics as M
from closecast.schema import PREDICTION, TARGET


def frame(spark, ys, ps, extra=None):
    rows = []
    for i, (y, p) in enumerate(zip(ys, ps)):
        r = {TARGET: float(y), PREDICTION: float(p)}
        if extra:
            r.update({k: v[i] for k, v in extra.items()})
        rows.append(r)
    return spark.createDataFrame(rows)


def test_perfect_prediction(spark):
    r = M.metrics_overall(frame(spark, [1, 2, 3, 4], [1, 2, 3, 4])).first()
    assert r["mae"] == 0 and r["rmse"] == 0 and r["wape"] == 0 and r["bias"] == 0
    assert r["r2"] == 1.0 and r["smape"] == 0


def test_wape_is_dollar_weighted(spark):
    assert M.metrics_overall(frame(spark, [100, 900], [110, 990])).first()["wape"] == pytest.approx(0.10)
    assert M.metrics_overall(frame(spark, [10, 9990], [20, 9990])).first()["wape"] == pytest.approx(0.001)


def test_bias_sign(spark):
    assert M.metrics_overall(frame(spark, [100, 100], [110, 110])).first()["bias"] == pytest.approx(0.10)
    assert M.metrics_overall(frame(spark, [100, 100], [90, 90])).first()["bias"] == pytest.approx(-0.10)


def test_smape_bounds_and_degenerate(spark):
    r = M.metrics_overall(frame(spark, [0, 0, 5], [0, 10, 5])).first()
    assert 0 <= r["smape"] <= 2
    # zero actuals: wape / bias undefined -> NULL; single row -> r2 NULL
    z = M.metrics_overall(frame(spark, [0.0], [1.0])).first()
    assert z["wape"] is None and z["bias"] is None and z["r2"] is None
    # constant actuals: r2 is 1 when perfect, else 0
    assert M.metrics_overall(frame(spark, [5, 5], [5, 5])).first()["r2"] == 1.0
    assert M.metrics_overall(frame(spark, [5, 5], [4, 6])).first()["r2"] == 0.0


def test_r2_matches_definition(spark):
    ys, ps = [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0]
    mean = sum(ys) / 4
    expect = 1 - sum((y - p) ** 2 for y, p in zip(ys, ps)) / sum((y - mean) ** 2 for y in ys)
    assert M.metrics_overall(frame(spark, ys, ps)).first()["r2"] == pytest.approx(expect)


def test_grouped_by_day(spark):
    df = frame(spark, [100, 200, 300, 400], [110, 190, 330, 360], {"snapshot_day": [10, 10, 20, 20]})
    rows = {r["snapshot_day"]: r for r in M.metrics_by_day(df).collect()}
    assert set(rows) == {10, 20}
    assert rows[10]["n"] == 2 and rows[10]["wape"] == pytest.approx(20 / 300)
    cube = M.metrics_cube(df.withColumn("facility_id", df["snapshot_day"].cast("string"))).collect()
    assert sorted(r["level"] for r in cube) == ["facility", "facility", "overall", "snapshot_day", "snapshot_day"]


def test_null_guard(spark):
    df = spark.createDataFrame([(1.0, None)], f"{TARGET} double, {PREDICTION} double")
    with pytest.raises(ValueError):
        M.assert_scorable(df)


def test_kpi_checkpoints_and_baseline(spark):
    by_day = spark.createDataFrame([(10, 30, 0.06, 0.0), (15, 30, 0.03, 0.0), (21, 30, 0.05, 0.0)],
                                   "snapshot_day bigint, n bigint, wape double, bias double")
    card = {r["snapshot_day"]: r for r in K.checkpoint_targets(by_day).collect()}
    assert [card[d]["met"] for d in (10, 15, 21)] == [True, True, False]
    base = spark.createDataFrame([(0.035, 0.06)], "champion_wape double, baseline_wape double")
    full = K.kpi_scorecard(by_day, base).collect()
    assert len(full) == 4
    kpi = [r for r in full if r["checkpoint"] == K.BASELINE_KPI_NAME][0]
    assert kpi["met"] and kpi["margin"] == pytest.approx(0.025) and kpi["snapshot_day"] is None


def test_continuous_evaluation_by_hand(spark):
    from closecast.plans.evaluation import continuous_evaluation

    keys = [("FAC-001", "2023-01", "2023-01-15", 15), ("FAC-001", "2023-02", "2023-02-15", 15),
            ("FAC-002", "2023-01", "2023-01-15", 15)]
    schema = "facility_id string, accounting_month string, snapshot_date string, snapshot_day bigint, v double"
    preds = spark.createDataFrame([(*k, p) for k, p in zip(keys, [1000.0, 2000.0, 3000.0])], schema) \
        .withColumnRenamed("v", PREDICTION)
    acts = spark.createDataFrame([(*k, y) for k, y in zip(keys, [1100.0, 1900.0, 3200.0])], schema) \
        .withColumnRenamed("v", TARGET)
    rep = continuous_evaluation(preds, acts)
    o = rep.overall.first()
    assert o["n"] == 3
    assert o["wape"] == pytest.approx(400 / 6200)
    assert o["bias"] == pytest.approx(-200 / 6200)
    assert rep.by_facility.count() == 2
    assert math.isclose(rep.scorecard().first()["value"], round(400 / 6200, 4))


def test_missing_values_and_duplicate_actuals_fail(spark):
    from closecast.operators.joins import predictions_vs_actuals

    rows = spark.createDataFrame([("a", 1, 100.0, 110.0), ("a", 1, 100.0, None)], "facility_id string, snapshot_day int, actual_month_end_net_revenue double, predicted_month_end_net_revenue double")
    for table in (M.metrics_overall(rows), M.metrics_by_day(rows), M.metrics_cube(rows)):
        with pytest.raises(Exception, match="a row has no"):
            table.collect()
    with pytest.raises(Exception, match="no rows to evaluate"):
        M.metrics_overall(rows.limit(0)).collect()
    key = "facility_id string, accounting_month string, snapshot_date string, snapshot_day bigint"
    preds = spark.createDataFrame([("a", "2020-01", "2020-01-05", 5, 1.0)], key + ", predicted_month_end_net_revenue double")
    actual = spark.createDataFrame([("a", "2020-01", "2020-01-05", 5, 1.0)] * 2, key + ", actual_month_end_net_revenue double")
    with pytest.raises(Exception, match="several actuals"):
        predictions_vs_actuals(preds, actual).collect()
    assert predictions_vs_actuals(preds, actual.limit(1)).count() == 1


def test_a_wape_just_above_its_ceiling_is_not_met(spark):
    from closecast.plans.evaluation import EvaluationReport

    rows = spark.createDataFrame([("f", 10, 1e7, 1e7 + 700004.0)], "facility_id string, snapshot_day int, actual_month_end_net_revenue double, predicted_month_end_net_revenue double")
    card = EvaluationReport(rows, M.metrics_cube(rows)).scorecard().first()
    assert not card["met"] and card["value"] == 0.07


def test_quantiles_do_not_depend_on_partitions(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from closecast.functions.quantiles import exact_quantiles

    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=3001), "b": np.repeat([1.0, 2.0], [2000, 5]), "c": np.array([4.0]), "d": rng.integers(0, 9, 700).astype(float)}
    levels = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v], "feature string, x double")
    for parts in (1, 7, 64):
        got = {r.feature: r.q for r in exact_quantiles(df.repartition(parts), levels).collect()}
        assert all(np.allclose(got[k], np.quantile(v, levels), rtol=0, atol=1e-12) for k, v in data.items())
    assert exact_quantiles(df.where(F.lit(False)), levels).count() == 0


def test_radix_quantiles_of_awkward_columns(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from closecast.functions.quantiles import column_quantiles, ordered_image, value_of

    rng = np.random.default_rng(8)
    hard = np.concatenate([rng.normal(size=400) * 10.0 ** rng.integers(-300, 300, 400), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308], np.full(900, 7.25)])
    near = 1.0 + np.arange(300) * 2.0 ** -52  # differ in the last bits only
    n = max(len(hard), len(near))
    rows = [(float(hard[i]) if i < len(hard) else None, float(near[i]) if i < len(near) else None, None) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    levels = [0.0, 0.2, 0.5, 0.77, 0.99, 1.0]
    got = column_quantiles(df, {c: F.col(c) for c in "abc"}, levels)
    assert set(got) == {"a", "b"}
    for name, values in (("a", np.sort(hard)), ("b", near)):
        for level, q in zip(levels, got[name]):
            p = level * (len(values) - 1)
            lo, hi = values[int(np.floor(p))], values[int(np.ceil(p))]
            assert lo <= q <= hi and (lo != hi or q == lo)
    image = ordered_image(np.sort(hard))
    assert (np.diff(image.astype(object)) >= 0).all() and [value_of(int(i)) for i in image] == np.sort(hard).tolist()
    assert column_quantiles(df.where("false"), {"a": F.col("a")}, levels) == {}


def test_quantile_passes_shuffle_counts_only(spark):
    from pyspark.sql import functions as F

    from closecast.functions.quantiles import _cell_counts

    df = spark.range(0, 50_000, 1, 4).select((F.col("id") % 3).cast("double").alias("c0"))
    counts = df.mapInArrow(_cell_counts(["c0"], None, 0, 16), "col int, cell long, n long, least long, largest long")
    assert counts.count() <= 3 * 8 and counts.agg(F.sum("n")).first()[0] == 50_000
