import datetime as dt
import os

from pyspark.sql import functions as F

from closecast import jobs
from closecast.streaming.mtd import EVENTS_SCHEMA, dropped_by_watermark, late_rows, month_to_date, rollup_with_ledger, start_daily_rollup

SF = "/root/testdata/sf0.001"


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, ts, 1, kind, v, "{}") for i, (ts, kind, v) in enumerate(rows)], EVENTS_SCHEMA)


def test_late_events_beyond_watermark_are_dropped_and_counted(spark, tmp_path):
    """Spark checks late events against the previous batch's watermark, so the
    late row arrives two micro-batches after the data that moved the watermark."""
    src = str(tmp_path / "events")
    batches = [
        [(dt.datetime(2024, 1, 10, 9), "click", 1.25), (dt.datetime(2024, 1, 12, 9), "click", 2.50)],
        [(dt.datetime(2024, 1, 13, 9), "click", 1.00)],
        [(dt.datetime(2024, 1, 2, 9), "click", 100.0), (dt.datetime(2024, 1, 13, 10), "click", 0.25)],
    ]
    for i, rows in enumerate(batches):
        _events(spark, rows).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    out = str(tmp_path / "out")
    q = start_daily_rollup(spark, os.path.join(src, "part*"), out, str(tmp_path / "ckpt"),
                           watermark="1 day", max_files_per_trigger=1)
    q.awaitTermination()
    assert dropped_by_watermark(spark, os.path.join(src, "part*"), out) == 1
    kept = str(tmp_path / "kept")
    rollup_with_ledger(spark, os.path.join(src, "part*"), kept, str(tmp_path / "ckpt2"), str(tmp_path / "ledger"), max_files_per_trigger=1)
    assert tuple(late_rows(spark, str(tmp_path / "ledger"), kept).first()) == (5, 4, 1)
    assert {r["batch_id"]: r["n_read"] for r in spark.read.parquet(str(tmp_path / "ledger")).collect() if r["n_read"]} == {0: 2, 1: 1, 2: 2}
    rows = {r["event_date"]: r for r in month_to_date(spark, out).collect()}
    assert "2024-01-02" not in rows
    assert rows["2024-01-13"]["n_events"] == 2 and rows["2024-01-13"]["value_sum"] == 1.25
    assert rows["2024-01-13"]["mtd_events"] == 4 and rows["2024-01-13"]["mtd_value"] == 5.0


def test_cli_build_validate_predict_evaluate(spark, tmp_path):
    snaps = str(tmp_path / "snaps.parquet")
    assert jobs.main(["build-snapshots", "--tables", SF, "--output", snaps]) == 0
    # sf0.001 has one closed facility-month without facts: the contract flags it
    assert jobs.main(["validate-data", "--input", snaps, "--quarantine", str(tmp_path / "bad.parquet")]) == 1
    assert spark.read.parquet(str(tmp_path / "bad.parquet")).count() == 8
    assert jobs.main(["validate-data", "--input", snaps, "--inference"]) == 0
    out = str(tmp_path / "train")
    train = ["train-local", "--input", snaps, "--output", out, "--candidates", "naive_prior,seasonal_naive"]
    assert jobs.main(train) == 1  # bad rows stop the run ...
    assert jobs.main([*train, "--quarantine", str(tmp_path / "bad_train")]) == 0  # ... unless they are kept somewhere
    assert spark.read.parquet(str(tmp_path / "bad_train")).count() == 8
    preds = str(tmp_path / "preds")
    assert jobs.main(["predict", "--bundle", os.path.join(out, "champion"), "--input", snaps,
                      "--output", preds, "--cutoff-day", "15"]) == 0
    scored = spark.read.parquet(os.path.join(preds, "predictions.parquet"))
    assert scored.count() == spark.read.parquet(snaps).count()
    assert scored.where(F.col("cutoff_day") != 15).isEmpty()
    csv_out = str(tmp_path / "predictions.csv")
    assert jobs.main(["predict", "--bundle", os.path.join(out, "champion"), "--input", snaps,
                      "--output", csv_out]) == 0
    assert spark.read.option("header", True).csv(csv_out).count() == scored.count()
    rep = str(tmp_path / "reports")
    assert jobs.main(["evaluate", "--predictions", os.path.join(preds, "predictions.parquet"),
                      "--actuals", snaps, "--output", rep, "--baseline-wape", "0.5"]) == 0
    assert set(os.listdir(rep)) >= {"evaluation_overall.json", "evaluation_by_facility.csv",
                                    "evaluation_by_snapshot_day.csv", "kpi_scorecard.csv"}
    assert jobs.main(["drift", "--reference", snaps, "--current", snaps, "--output", str(tmp_path / "drift")]) == 0


def test_jobs_refuse_missing_columns_and_bad_rows(spark, tmp_path, snaps):
    part = str(tmp_path / "part.parquet")
    snaps.drop("quarter", "month_to_date_encounters").limit(20).write.parquet(part)
    assert jobs.main(["validate-data", "--input", part]) == 1
    assert jobs.main(["train-local", "--input", part, "--output", str(tmp_path / "o")]) == 1
    bundle = str(tmp_path / "bundle")
    from closecast.operators.baselines import naive_prior
    from closecast.operators.scoring import ModelBundle, save_bundle
    from pyspark.ml import PipelineModel

    save_bundle(ModelBundle("naive_prior", PipelineModel(stages=[naive_prior().fit(snaps)])), bundle)
    assert jobs.main(["predict", "--bundle", bundle, "--input", part, "--output", str(tmp_path / "p")]) == 1
    bad = str(tmp_path / "rows.parquet")
    one = snaps.agg(F.min("facility_id")).first()[0]
    snaps.withColumn("month_to_date_payments", F.when(F.col("facility_id") == one, F.lit(-5.0)).otherwise(F.col("month_to_date_payments"))).write.parquet(bad)
    want = snaps.where(F.col("facility_id") == one).count()
    assert want > 0 and jobs.main(["predict", "--bundle", bundle, "--input", bad, "--output", str(tmp_path / "p")]) == 1
    assert jobs.main(["predict", "--bundle", bundle, "--input", bad, "--output", str(tmp_path / "p"), "--quarantine", str(tmp_path / "q")]) == 0
    assert spark.read.parquet(str(tmp_path / "q")).count() == want
    assert spark.read.parquet(str(tmp_path / "p" / "predictions.parquet")).count() == snaps.count() - want


def test_write_modes_and_rewritten_input(spark, tmp_path, snaps):
    from closecast.sources.snapshot_io import read_snapshots, write_snapshots

    path = str(tmp_path / "s.parquet")
    months = [r[0] for r in snaps.select("accounting_month").distinct().orderBy("accounting_month").limit(3).collect()]
    write_snapshots(snaps.where(F.col("accounting_month").isin(months)), path)
    write_snapshots(snaps.where(F.col("accounting_month") == months[0]), path, mode="replace_months")
    assert read_snapshots(spark, path).select("accounting_month").distinct().count() == 3
    write_snapshots(snaps.where(F.col("accounting_month").isin(months[:2])), path)
    assert read_snapshots(spark, path).select("accounting_month").distinct().count() == 2


def test_cli_validates_text_input_with_coercion(spark, tmp_path, snaps):
    csv = str(tmp_path / "bad.csv")
    broken = snaps.where(F.col("actual_month_end_net_revenue") > 0).limit(10).withColumn(
        "month_to_date_payments", F.lit("n/a"))
    broken.coalesce(1).write.option("header", True).csv(csv)
    assert jobs.main(["validate-data", "--input", csv]) == 1
    good = str(tmp_path / "good.csv")
    snaps.where(F.col("actual_month_end_net_revenue") > 0).limit(10).coalesce(1).write.option("header", True).csv(good)
    assert jobs.main(["validate-data", "--input", good]) == 0
