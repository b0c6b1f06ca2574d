"""Batch job entry points (``spark-submit closecast/jobs.py <command> ...``).

Each command is a plain-argument Spark job: read -> operator -> write. The
session comes from spark-submit on a cluster; ``--master`` is only for local
runs.

commands:
  generate-data     seeded synthetic snapshots (fixtures)            -> Parquet/CSV
  build-snapshots   as-of snapshots from the transaction tables (G11) -> Parquet by month
  validate-data     contract + leakage rules; exit code 1 on failure, quarantine written
  train-local       contract -> split -> candidates -> champion bundle + comparison CSV
  predict           load bundle -> inference contract -> score -> predictions sink
  evaluate          predictions vs actuals -> metric reports + KPI scorecard
  drift             PSI report of a current vs a reference snapshot set
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if args.master:
        from closecast.session import get_session

        return get_session(cpus=args.master.split("[")[-1].rstrip("]") if "[" in args.master else "*")
    spark = SparkSession.builder.appName(f"closecast-{args.command}").getOrCreate()
    from closecast.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark


def _refused(why: str) -> int:
    """A job that would lose or invent rows stops with its reason."""
    print(json.dumps({"error": why}))
    return 1


def cmd_generate(spark, args) -> int:
    from closecast.sources.generator import GeneratorConfig, generate_snapshots
    from closecast.sources.snapshot_io import write_snapshots

    cfg = GeneratorConfig(seed=args.seed, n_facilities=args.facilities, n_months=args.months)
    write_snapshots(generate_snapshots(spark, cfg), args.output)
    print(json.dumps({"written": args.output}))
    return 0


def cmd_build(spark, args) -> int:
    from closecast.plans.snapshots import build_snapshots
    from closecast.sources.snapshot_io import write_snapshots

    days = [int(d) for d in args.days.split(",")] if args.days else None
    write_snapshots(build_snapshots(spark, args.tables, days), args.output)
    print(json.dumps({"written": args.output}))
    return 0


def cmd_validate(spark, args) -> int:
    from pyspark.sql import functions as F

    from closecast.operators import contracts as C
    from closecast.sources.snapshot_io import missing_source_columns, read_snapshots, write_snapshots

    need_target = not args.inference
    absent = missing_source_columns(spark, args.input, need_target)
    if absent:
        print(json.dumps({"valid": False, "errors": [f"missing columns {absent}"]}))
        return 1
    if args.input.rstrip("/").lower().endswith(".csv"):
        # text input: coerce to the contract types, report unparseable values too
        text = spark.read.option("header", True).csv(args.input)
        df = C.coerce_to_schema(text, need_target).drop("coerce_failures")
        n_coerce = C.coerced_contract_failures(text, need_target).where(
            F.col("check").startswith("coerce_dtype")).count()
    else:
        df, n_coerce = read_snapshots(spark, args.input, with_target=need_target), 0
    good, bad = C.quarantine(df, require_target=need_target)
    n_bad = bad.count()
    if args.quarantine and n_bad:
        write_snapshots(bad, args.quarantine, partition_by=None)
    errors = []
    if n_coerce:
        errors.append(f"{n_coerce} values do not parse as their contract type")
    if n_bad:
        errors.append(f"{n_bad} rows fail the contract")
    try:
        C.validate_leakage_rules(df)
    except C.ContractViolation as exc:
        errors.append(str(exc))
    print(json.dumps({"valid": not errors, "errors": errors}))
    return 1 if errors else 0


def cmd_train(spark, args) -> int:
    from closecast.operators.models import ModelConfig
    from closecast.operators.scoring import save_bundle
    from closecast.operators.contracts import ContractViolation
    from closecast.plans.training import run_training_pipeline
    from closecast.sources.snapshot_io import missing_source_columns, read_snapshots, write_csv

    cfg = ModelConfig(candidates=args.candidates.split(",")) if args.candidates else ModelConfig()
    if absent := missing_source_columns(spark, args.input):
        return _refused(f"missing columns {absent}")
    try:
        out = run_training_pipeline(read_snapshots(spark, args.input), cfg, quarantine_path=args.quarantine)
    except ContractViolation as exc:
        return _refused(str(exc))
    save_bundle(out.champion_bundle, os.path.join(args.output, "champion"))
    write_csv(out.selection.ranking, os.path.join(args.output, "comparison.csv"))
    print(json.dumps({"champion": out.selection.champion, "challenger": out.selection.challenger,
                      "promotable": out.selection.challenger_promotable, "quarantined": out.quarantined}))
    return 0


def cmd_predict(spark, args) -> int:
    from closecast.operators import contracts as C
    from closecast.operators.scoring import batch_score, load_bundle
    from closecast.schema import TARGET
    from closecast.sources.snapshot_io import missing_source_columns, read_snapshots, write_csv, write_predictions

    bundle = load_bundle(args.bundle)
    if absent := missing_source_columns(spark, args.input, with_target=False):
        return _refused(f"missing columns {absent}")
    raw = read_snapshots(spark, args.input, with_target=False)
    try:
        good, n_bad = C.accepted_rows(raw.drop(TARGET) if TARGET in raw.columns else raw, args.quarantine, require_target=False)
    except C.ContractViolation as exc:
        return _refused(str(exc))
    scored = batch_score(bundle, good, cutoff_day=args.cutoff_day)
    if args.output.rstrip("/").lower().endswith(".csv"):
        path = write_csv(scored, args.output)  # A6: batch-score CSV sink
    else:
        path = write_predictions(scored, args.output)
    print(json.dumps({"written": path, "quarantined": n_bad}))
    return 0


def cmd_evaluate(spark, args) -> int:
    from closecast.plans.evaluation import run_continuous_evaluation
    from closecast.sources.snapshot_io import read_snapshots

    preds = spark.read.parquet(args.predictions)
    actuals = read_snapshots(spark, args.actuals)
    stats = run_continuous_evaluation(preds, actuals, args.output, args.baseline_wape)
    print(json.dumps(stats))
    return 0


def cmd_drift(spark, args) -> int:
    from closecast.operators import drift as D
    from closecast.schema import HISTORICAL, OPERATIONAL, TARGET
    from closecast.sources.snapshot_io import read_snapshots, write_csv

    ref = read_snapshots(spark, args.reference)
    cur = read_snapshots(spark, args.current)
    cols = args.columns.split(",") if args.columns else OPERATIONAL + HISTORICAL + [TARGET]
    report = D.drift_report(ref, cur, cols)
    write_csv(report, os.path.join(args.output, "drift_report.csv"))
    s = D.drift_summary(report).first()
    print(json.dumps({"max_psi": s["max_psi"], "status": s["status"]}))
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="closecast")
    p.add_argument("--master", default=None, help="local[N] for local runs; omit under spark-submit")
    sub = p.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate-data")
    g.add_argument("--output", required=True)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--facilities", type=int, default=6)
    g.add_argument("--months", type=int, default=30)
    b = sub.add_parser("build-snapshots")
    b.add_argument("--tables", required=True, help="directory with lineitem/supplier/nation/region Parquet")
    b.add_argument("--output", required=True)
    b.add_argument("--days", default=None, help="comma-separated snapshot days (1-28)")
    v = sub.add_parser("validate-data")
    v.add_argument("--input", required=True)
    v.add_argument("--inference", action="store_true", help="target may be absent")
    v.add_argument("--quarantine", default=None, help="where failing rows are written")
    t = sub.add_parser("train-local")
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--candidates", default=None)
    t.add_argument("--quarantine", default=None, help="continue without rows that break the contract; they are written here (Parquet)")
    pr = sub.add_parser("predict")
    pr.add_argument("--bundle", required=True)
    pr.add_argument("--input", required=True)
    pr.add_argument("--output", required=True)
    pr.add_argument("--cutoff-day", type=int, default=None)
    pr.add_argument("--quarantine", default=None, help="continue without rows that break the contract; they are written here (Parquet)")
    e = sub.add_parser("evaluate")
    e.add_argument("--predictions", required=True)
    e.add_argument("--actuals", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--baseline-wape", type=float, default=None)
    d = sub.add_parser("drift")
    d.add_argument("--reference", required=True)
    d.add_argument("--current", required=True)
    d.add_argument("--output", required=True)
    d.add_argument("--columns", default=None)
    return p


COMMANDS = {"generate-data": cmd_generate, "build-snapshots": cmd_build, "validate-data": cmd_validate,
            "train-local": cmd_train, "predict": cmd_predict, "evaluate": cmd_evaluate, "drift": cmd_drift}


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    return COMMANDS[args.command](_session(args), args)


if __name__ == "__main__":
    sys.exit(main())
