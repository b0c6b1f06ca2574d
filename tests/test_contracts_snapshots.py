import pytest
from pyspark.sql import functions as F

from closecast.operators import contracts as C
from closecast.plans.snapshots import build_snapshots_from
from closecast.sources import snapshot_io as IO
from closecast.sources.tables import read_table
from closecast.schema import ALL_COLUMNS, KEYS, TARGET

SF = "/root/testdata/sf0.001"


def test_valid_closed_months_pass_row_rules(snaps):
    # sf0.001 has one closed facility-month with no facts: target 0 -> quarantined
    good, bad = C.quarantine(snaps)
    assert bad.count() == 8 and good.count() == snaps.count() - 8
    C.validate_raw_snapshots(good)
    C.validate_leakage_rules(good)


def test_invalid_sample_fails_with_three_faults(snaps):
    bad = IO.invalid_sample(snaps, 20)
    fails = {(r["column"], r["check"]) for r in C.contract_failures(bad).collect()}
    assert fails == {("facility_id", "str_matches('^FAC-\\d{3}$')"), (TARGET, "greater_than(0)"),
                     ("snapshot_day", "in_range(1, 31)")}
    with pytest.raises(C.ContractViolation):
        C.validate_raw_snapshots(bad)


def test_days_elapsed_leak_detected(snaps):
    leaked = snaps.withColumn("days_elapsed", F.col("days_elapsed") + 1)
    with pytest.raises(C.ContractViolation, match="days_elapsed"):
        C.validate_leakage_rules(leaked)


def test_target_variation_detected(snaps):
    varied = snaps.withColumn(TARGET, F.when(F.col("snapshot_day") == 7, F.col(TARGET) + 1).otherwise(F.col(TARGET)))
    with pytest.raises(C.ContractViolation, match="target varies"):
        C.validate_leakage_rules(varied)


def test_inference_mode_without_target(snaps):
    C.validate_raw_snapshots(snaps.where(F.col(TARGET) > 0).drop(TARGET), require_target=False)
    assert C.missing_columns(snaps.drop("quarter")) == ["quarter"]


def test_unparseable_date_skips_date_rules(snaps):
    rows = C.leakage_report(snaps.withColumn("snapshot_date", F.lit("not-a-date"))).collect()
    got = {r["rule"]: r["violations"] for r in rows}
    assert got["unparseable_date"] > 0 and got["day_matches_date"] is None and got["date_in_month"] is None


def _tables(spark):
    return [read_table(spark, SF, t) for t in ("lineitem", "supplier", "nation", "region")]


def test_no_future_leakage(spark):
    """Changing any fact shipped on or after date T must not change a snapshot dated before T."""
    li, sup, nat, reg = _tables(spark)
    base = build_snapshots_from(li, sup, nat, reg)
    cutoff = "1998-06-20"
    mutated_li = li.withColumn(
        "l_extendedprice",
        F.when(F.col("l_shipdate") >= F.lit(cutoff).cast("timestamp"), F.col("l_extendedprice") * 3 + 1000)
        .otherwise(F.col("l_extendedprice")))
    mutated = build_snapshots_from(mutated_li, sup, nat, reg)
    cols = [c for c in ALL_COLUMNS if c != TARGET]  # the target is post-close by definition
    before = lambda df: df.where(F.col("snapshot_date") < cutoff).select(*cols)
    assert before(base).count() > 0
    assert before(base).exceptAll(before(mutated)).isEmpty()
    # ... while snapshots on/after the cutoff do see the change
    after = lambda df: df.where(F.col("snapshot_date") >= "1998-06-21").select(*cols)
    assert not after(base).exceptAll(after(mutated)).isEmpty()


def test_snapshots_independent_of_partitioning(spark):
    li, sup, nat, reg = _tables(spark)
    one = build_snapshots_from(li.coalesce(1), sup, nat, reg)
    many = build_snapshots_from(li.repartition(7), sup, nat, reg)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_history_is_strictly_prior(snaps):
    first = snaps.where(F.col("accounting_month") == snaps.agg(F.min("accounting_month")).first()[0])
    assert first.where(F.col("prior_month_net_revenue").isNotNull()).isEmpty()
    assert first.where(F.col("rolling_12_month_net_revenue").isNotNull()).isEmpty()


def test_read_rejects_unknown_suffix(spark):
    with pytest.raises(ValueError):
        IO.read_snapshots(spark, "/tmp/x.json")


def test_coercion_failures_are_reported(spark, snaps):
    text = snaps.limit(5).select(*[F.col(c).cast("string").alias(c) for c in snaps.columns])
    broken = text.withColumn("month_to_date_payments",
                             F.when(F.col("snapshot_day") == 7, F.lit("n/a")).otherwise(F.col("month_to_date_payments")))
    fails = C.coerced_contract_failures(broken).collect()
    bad = [r for r in fails if r["check"].startswith("coerce_dtype")]
    assert bad and all(r["column"] == "month_to_date_payments" and r["failure_case"] == "n/a" for r in bad)
    assert C.coerced_contract_failures(text).count() == C.contract_failures(snaps.limit(5)).count()
