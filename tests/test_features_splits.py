import pytest
from pyspark.sql import functions as F

from closecast.operators import splits as T
from closecast.operators.contracts import check_forbidden
from closecast.operators.features import LeakageSafeFeatures
from closecast.schema import TARGET


def feature_frame(spark):
    rows = [(100.0, 10.0, 10.0, 20.0, "a"), (None, 20.0, 15.0, 15.0, "b"),
            (300.0, None, 20.0, 10.0, "a"), (400.0, 40.0, 25.0, 5.0, "b")]
    return spark.createDataFrame(rows, "month_to_date_gross_charges double, month_to_date_payments double, "
                                       "days_elapsed double, remaining_days double, service_line_group string")


def test_transform_has_no_missing_and_uses_train_medians(spark):
    df = feature_frame(spark)
    model = LeakageSafeFeatures(outputCol="").fit(df)
    assert model.medians["month_to_date_gross_charges"] == 300.0
    assert model.medians["month_to_date_payments"] == 20.0
    out = model.transform(df)
    names = model.feature_names()
    nulls = out.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in names]).first()
    assert all(v == 0 for v in nulls)
    assert "service_line_group__a" in names and "service_line_group__b" in names


def test_unseen_and_null_category_are_all_zero(spark):
    df = feature_frame(spark)
    model = LeakageSafeFeatures(outputCol="").fit(df)
    new = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, "zzz"), (1.0, 1.0, 1.0, 1.0, None)],
                                df.schema)
    rows = model.transform(new).select("service_line_group__a", "service_line_group__b").collect()
    assert all(r[0] == 0.0 and r[1] == 0.0 for r in rows)


def test_missing_numeric_column_gets_median(spark):
    df = feature_frame(spark)
    model = LeakageSafeFeatures(outputCol="").fit(df)
    out = model.transform(df.drop("month_to_date_payments")).select("month_to_date_payments").distinct().collect()
    assert [r[0] for r in out] == [20.0]


def test_forbidden_columns_rejected(spark):
    with pytest.raises(ValueError):
        check_forbidden(["a", "final_denials"])
    df = feature_frame(spark).withColumn("month_end_close_flag", F.lit(1))
    with pytest.raises(ValueError):
        LeakageSafeFeatures().fit(df)
    # the label may ride along for the next stage
    LeakageSafeFeatures(outputCol="").fit(feature_frame(spark).withColumn(TARGET, F.lit(1.0)))


def test_blocked_split_disjoint_and_keeps_facility_months(snaps):
    sp = T.blocked_temporal_split(snaps)
    tr, va, te = set(sp.train_months), set(sp.validation_months), set(sp.test_months)
    assert not (tr & va) and not (tr & te) and not (va & te)
    assert len(te) == 4 and len(va) == 4 and max(tr) < min(va) <= max(va) < min(te)
    assert sp.train.select("accounting_month").intersect(sp.test.select("accounting_month")).isEmpty()
    tagged = T.with_split_column(snaps)
    per_fm = tagged.groupBy("facility_id", "accounting_month").agg(F.countDistinct("split").alias("k"))
    assert per_fm.where("k > 1").isEmpty()


def test_folds_are_time_ordered(snaps):
    months = T.ordered_months(snaps)
    for fn in (T.rolling_fold_windows, T.expanding_fold_windows):
        wins = fn(len(months))
        assert wins
        for tlo, thi, vlo, vhi in wins:
            assert thi == vlo and tlo < thi < vhi <= len(months)
    cal = T.fold_calendar(snaps, "rolling").collect()
    by_fold = {}
    for r in cal:
        by_fold.setdefault((r["fold_id"], r["role"]), []).append(r["accounting_month"])
    for f in {k[0] for k in by_fold}:
        assert max(by_fold[(f, "train")]) < min(by_fold[(f, "validation")])


def test_too_few_months_raises():
    with pytest.raises(ValueError):
        T.blocked_months(["2023-01", "2023-02"], T.SplitConfig(1, 1, 1))


def test_fold_windows_match_the_published_rule():
    cfg = T.SplitConfig(n_test_months=3, n_val_months=3, n_backtest_folds=2)
    # rolling: min_train = max(h, M - k*h) = 12 -> train [0,12) val [12,15); train [3,15) val [15,18)
    assert T.rolling_fold_windows(18, cfg) == [(0, 12, 12, 15), (3, 15, 15, 18)]
    # expanding: first = M - k*h = 12 -> train [0,12) val [12,15); train [0,15) val [15,18)
    assert T.expanding_fold_windows(18, cfg) == [(0, 12, 12, 15), (0, 15, 15, 18)]
    # too few months for k folds: expanding falls back to first = h and stops when out of months
    assert T.expanding_fold_windows(5, cfg) == []
    assert T.expanding_fold_windows(7, cfg) == [(0, 1, 1, 4), (0, 4, 4, 7)]  # first = 7 - 6 = 1
    assert T.rolling_fold_windows(5, cfg) == []


def test_the_strategy_names_the_splits(snaps):
    months = T.ordered_months(snaps)
    one, = T.temporal_splits(snaps)
    assert one.test_months == months[-4:]
    for strategy, windows in (("rolling_origin", T.rolling_fold_windows), ("expanding_window", T.expanding_fold_windows)):
        got = T.temporal_splits(snaps, T.SplitConfig(strategy=strategy, n_backtest_folds=2))
        want = windows(len(months), T.SplitConfig(n_backtest_folds=2))
        assert [(s.train_months, s.validation_months) for s in got] == [(months[a:b], months[c:d]) for a, b, c, d in want]
        for s in got:
            assert max(s.train_months) < min(s.validation_months) and s.test_months == s.validation_months
            assert sorted({r[0] for r in s.train.select("accounting_month").distinct().collect()}) == s.train_months
    with pytest.raises(ValueError):
        T.SplitConfig(strategy="random")
    with pytest.raises(ValueError):
        T.temporal_splits(snaps.where(snaps.accounting_month == months[0]), T.SplitConfig(strategy="expanding_window"))


def test_a_column_of_too_many_categories_is_refused(spark):
    wide = spark.range(3000).selectExpr("cast(id as string) AS service_line_group", "1.0D AS days_elapsed")
    with pytest.raises(ValueError, match="service_line_group"):
        LeakageSafeFeatures().fit(wide)
