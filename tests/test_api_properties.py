"""Properties the reference's API tests pin, checked on the registered queries."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_gross_to_net_is_a_positive_average_over_all_rows(spark):
    # On the generator data the ratio exceeds 1; on the fact adapter mid-month
    # gross is about half of the month's net, so only structure is checked.
    r = q(spark, "gross_to_net").first()
    assert r["average_gross_to_net_ratio"] > 0 and r["n_ratios"] <= r["n_rows"]


def test_correlations_bounded(spark):
    rows = q(spark, "target_correlation").collect()
    assert rows and all(r["corr_with_target"] is None or -1 <= r["corr_with_target"] <= 1 for r in rows)
    vals = [abs(r["corr_with_target"]) for r in rows if r["corr_with_target"] is not None]
    assert vals == sorted(vals, reverse=True)


def test_split_summary_blocks(spark):
    rows = {r["split"]: r for r in q(spark, "split_summary").collect()}
    assert rows["test"]["n_months"] == 4 and rows["validation"]["n_months"] == 4
    assert rows["train"]["last_month"] < rows["validation"]["first_month"] <= rows["validation"]["last_month"] \
        < rows["test"]["first_month"]


def test_overview_and_series(spark):
    o = q(spark, "dataset_overview").first()
    assert o["n_rows"] == o["n_facilities"] * o["n_months"] * 8
    months = [r["accounting_month"] for r in q(spark, "facility_month_series").select("accounting_month")
              .distinct().orderBy("accounting_month").collect()]
    assert len(months) == o["n_months"] and months[0] == o["first_month"] and months[-1] == o["last_month"]


def test_one_champion(spark):
    rows = q(spark, "comparison_table").collect()
    assert sum(r["is_champion"] for r in rows) == 1


@pytest.mark.parametrize("name", ["feature_preview"])
def test_feature_preview_counts(spark, name):
    r = q(spark, name).first()
    assert r["n_raw"] == 41 and r["n_engineered"] > 43


def test_model_backtest_agrees_with_sql_checked_baseline_backtest(spark):
    models = {(r["fold_id"], r["model"]): r["wape"] for r in q(spark, "backtest_models").collect()}
    for r in q(spark, "backtest_baselines").collect():
        assert models[(r["fold_id"], "naive_prior")] == pytest.approx(r["wape_naive_prior"], abs=2e-6)
        assert models[(r["fold_id"], "seasonal_naive")] == pytest.approx(r["wape_seasonal_naive"], abs=2e-6)
    assert {k[1] for k in models} == {"naive_prior", "seasonal_naive", "elastic_net"}
