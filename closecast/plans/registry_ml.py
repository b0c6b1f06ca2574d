"""Registered queries for model training, scoring with intervals, explanation
and streaming. Trained models are not SQL-expressible: these are rows-only,
except the bundle round trip whose output equals the SQL baseline."""

from __future__ import annotations

import os
import threading

from pyspark.sql import functions as F

from closecast.operators import drift as D
from closecast.operators import explain as X
from closecast.operators import metrics as M
from closecast.operators import scoring as B
from closecast.operators.models import ModelConfig, build_estimator, fit_features, interval_columns, tune_learning_rate
from closecast.operators.selection import release_gate
from closecast.plans import oracle_sql as O
from closecast.plans.common import SEASONAL, baseline_scored, naive_bundle, snapshots
from closecast.plans.snapshots import input_key
from closecast.plans.registry import ORACLE_SQL, QUERIES, SEL_TABLE, SPLIT, W, register
from closecast.operators.splits import blocked_temporal_split
from closecast.plans.training import TEST_PROFILE_CANDIDATES, known_training, memo_training
from closecast.schema import KEYS, PREDICTION, TARGET
from closecast.sources.snapshot_io import scratch_path


def _trained(spark, sf_dir):
    return memo_training(spark, sf_dir, snapshots(spark, sf_dir), TEST_PROFILE_CANDIDATES)


@register("train_candidates")
def q_train_candidates(spark, sf_dir):
    """Contract -> blocked split -> the test-profile candidates
    (baselines, elastic net, histogram boosting) -> ranked comparison table."""
    out = _trained(spark, sf_dir)
    return M.reported(out.selection.ranking)


@register("candidate_metrics_by_day")
def q_candidate_metrics_by_day(spark, sf_dir):
    """Per-candidate test metrics by snapshot day."""
    out = _trained(spark, sf_dir)
    frames = [r.by_day.withColumn("model", F.lit(n)) for n, r in out.results.items()]
    res = frames[0]
    for f in frames[1:]:
        res = res.unionByName(f)
    return M.reported(res)


@register("tune_grid")
def q_tune_grid(spark, sf_dir):
    """Learning-rate sweep of histogram boosting, scored on the validation
    block; the default-rate model of this session's training run is reused if there is one."""
    out = known_training(spark, sf_dir, TEST_PROFILE_CANDIDATES)  # not trained just for this
    if out is None:
        return tune_learning_rate(blocked_temporal_split(snapshots(spark, sf_dir))).withColumn("wape", F.round("wape", 6))
    default_lr = ModelConfig().hgb_params["learning_rate"]
    hgb = out.results["hist_gradient_boosting"].model.stages[-1]
    return tune_learning_rate(out.split, cache=out.features, fitted={default_lr: hgb}).withColumn("wape", F.round("wape", 6))


def _learned_champion(out):
    """The champion if it is a learned model, else the best-ranked learned one."""
    ranked = [r["model"] for r in out.selection.ranking.orderBy("rank").select("model").collect()]
    for name in ranked:
        if name not in ("naive_prior", "seasonal_naive"):
            return name
    return None


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """Permutation importance of the best learned model on the test block."""
    out = _trained(spark, sf_dir)
    name = _learned_champion(out)
    if name is None:
        return spark.createDataFrame([("prior_period_baseline", 1.0, 0.0)],
                                     "feature string, importance_mean double, importance_std double")
    fm, reg = out.results[name].model.stages
    names = fm.feature_names()
    test = fm.transform(out.split.test).select(*names, TARGET)
    return X.permutation_importance(reg, test, names, n_repeats=5)


_BOOSTED: dict = {}
_BOOSTED_LOCK = threading.Lock()


def _boosted(spark, sf_dir):
    """(split, feature stage, histogram boosting): of this session's training run if there is one, else fitted alone."""
    key = input_key(spark, sf_dir)
    with _BOOSTED_LOCK:
        if key not in _BOOSTED:
            out = known_training(spark, sf_dir, TEST_PROFILE_CANDIDATES)
            if out is not None:
                _BOOSTED[key] = (out.split, *out.results["hist_gradient_boosting"].model.stages)
            else:
                split = blocked_temporal_split(snapshots(spark, sf_dir))
                cache = fit_features(split)
                _BOOSTED[key] = (split, cache.model, build_estimator("hist_gradient_boosting", ModelConfig()).fit(cache.train))
                cache.release()
        return _BOOSTED[key]


@register("native_importance")
def q_native_importance(spark, sf_dir):
    """Built-in importances of the boosted-tree candidate."""
    _, fm, reg = _boosted(spark, sf_dir)
    return X.native_importance(reg, fm.feature_names())


@register("shap_global")
def q_shap_global(spark, sf_dir):
    """Mean |SHAP| of the boosted-tree candidate over all test rows, exact."""
    split, fm, reg = _boosted(spark, sf_dir)
    names = fm.feature_names()
    test = fm.transform(split.test).select(*KEYS, *names)
    return X.shap_global(reg, test, names, top=12)


_FOREST: dict = {}
_FOREST_LOCK = threading.Lock()


def _forest(spark, sf_dir):
    key = input_key(spark, sf_dir)
    with _FOREST_LOCK:
        return _forest_locked(spark, sf_dir, key)


def _forest_locked(spark, sf_dir, key):
    if key not in _FOREST:
        split = blocked_temporal_split(snapshots(spark, sf_dir))
        cache = fit_features(split)
        rf = build_estimator("random_forest", ModelConfig()).fit(cache.train)
        _FOREST[key] = (split, cache, rf)
    return _FOREST[key]


@register("score_interval")
def q_score_interval(spark, sf_dir):
    """B1/B2: random-forest scoring of the test block with per-tree spread and
    +-1.96 std bounds, plus lineage columns."""
    from pyspark.ml import PipelineModel

    split, cache, rf = _forest(spark, sf_dir)
    bundle = B.ModelBundle("random_forest", PipelineModel(stages=[cache.model, rf]), run_id="forest-run")
    bundle.interval = rf
    return B.batch_score(bundle, split.test)


@register("interval_coverage")
def q_interval_coverage(spark, sf_dir):
    """Share of test actuals inside the forest's interval, by snapshot day."""
    split, cache, rf = _forest(spark, sf_dir)
    scored, cols = interval_columns(rf.transform(cache.test), rf)
    with_bounds = scored.select(TARGET, "snapshot_day", *cols)
    return M.interval_coverage(with_bounds, group_col="snapshot_day")


@register("bundle_roundtrip", ORACLE_SQL["batch_score"])
def q_bundle_roundtrip(spark, sf_dir):
    """Save the baseline bundle with the ML writer, load it, score raw rows."""
    path = scratch_path(spark, "bundle").replace(".parquet", "")
    B.save_bundle(naive_bundle(spark, sf_dir), path)
    loaded = B.load_bundle(path)
    return B.batch_score(loaded, snapshots(spark, sf_dir), scored_at="2001-11-01 00:00:00")



# ---------------------------------------------------------------- streaming
@register("stream_score", ORACLE_SQL["batch_score"])
def q_stream_score(spark, sf_dir):
    """Streaming scoring of the snapshot files (availableNow): equals batch scoring."""
    from closecast.plans.snapshots import snapshot_table
    from closecast.streaming.score import read_scored, start_stream_score

    snaps = snapshot_table(spark, sf_dir)
    source = snaps.inputFiles()[0].split("/accounting_month=")[0]
    out = scratch_path(spark, "stream_score").replace(".parquet", "")
    q = start_stream_score(spark, source, naive_bundle(spark, sf_dir), out, out + "_ckpt",
                           scored_at="2001-11-01 00:00:00")
    q.awaitTermination()
    return read_scored(spark, out)


_MTD_SQL = """
SELECT strftime(d, '%Y-%m-%d') AS event_date, event_type, n_events, CAST(vs AS DOUBLE) AS value_sum,
       CAST(SUM(n_events) OVER w AS BIGINT) AS mtd_events, CAST(SUM(vs) OVER w AS DOUBLE) AS mtd_value
FROM (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, event_type, COUNT(*) AS n_events,
             SUM(CAST(value AS DECIMAL(12,2))) AS vs
      FROM events GROUP BY 1, 2)
WINDOW w AS (PARTITION BY event_type, date_trunc('month', d) ORDER BY d
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@register("stream_mtd", _MTD_SQL)
def q_stream_mtd(spark, sf_dir):
    """Watermarked daily event windows, rolled up month-to-date."""
    from closecast.streaming.mtd import month_to_date, start_daily_rollup

    out = scratch_path(spark, "stream_mtd").replace(".parquet", "")
    src = os.path.join(sf_dir, "events.parque[t]")  # glob: the single events file
    q = start_daily_rollup(spark, src, out, out + "_ckpt")
    q.awaitTermination()
    return month_to_date(spark, out)


_LATE_SQL = """
WITH late AS (SELECT ts FROM events WHERE event_id % 50 = 0 AND ts < (SELECT min(ts) FROM events) + INTERVAL 10 DAY),
seen AS (SELECT count(*) + (SELECT count(*) FROM late) AS n, max(ts) AS newest FROM events),
gone AS (SELECT count(*) AS n FROM late, seen WHERE date_trunc('day', late.ts) + INTERVAL 1 DAY <= newest - INTERVAL 1 DAY)
SELECT seen.n + 1 AS n_read, seen.n + 1 - gone.n AS n_counted, gone.n AS n_dropped FROM seen, gone"""


@register("stream_late_rows", _LATE_SQL)
def q_stream_late_rows(spark, sf_dir):
    """Daily event windows of a stream with planted late rows: every fiftieth event of the first ten days comes
    once more after the newest events; rows read are kept per epoch, those that reach no window are late."""
    from closecast.sources.tables import read_table
    from closecast.streaming.mtd import EVENTS_SCHEMA, late_rows, rollup_with_ledger

    events = read_table(spark, sf_dir, "events").select(*[f.split()[0] for f in EVENTS_SCHEMA.split(", ")])
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last"), (F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("mid")).first()  # one row
    folder = scratch_path(spark, "late_events").replace(".parquet", "")
    newest = events.where(F.col("ts") == ends["last"]).orderBy("event_id").limit(1)
    late = events.where((F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(ends["first"]) + F.expr("INTERVAL 10 DAYS")))
    # the files come one per micro-batch, in the order of their writing; the third only moves the watermark on
    for part in (events.where(F.col("ts") < F.lit(ends["mid"])), events.where(F.col("ts") >= F.lit(ends["mid"])), newest, late):
        part.coalesce(1).write.mode("append").parquet(folder + "_src")
    out = folder + "_out"
    rollup_with_ledger(spark, folder + "_src", out, folder + "_ckpt", folder + "_ledger", max_files_per_trigger=1)
    return late_rows(spark, folder + "_ledger", out)


@register("backtest_models")
def q_backtest_models(spark, sf_dir):
    """T5: baselines and elastic net of every expanding and rolling fold, from one moment matrix a month, measured on the fold's validation months."""
    from closecast.operators.moments import backtest_linear

    p = ModelConfig().elastic_net_params
    return M.reported(backtest_linear(snapshots(spark, sf_dir), alpha=p["alpha"], l1_ratio=p["l1_ratio"], max_iter=p["max_iter"]))


@register("release_gate", W(f"""
SELECT n, round(iw, 6) AS incumbent_wape, round(cw, 6) AS candidate_wape, round((iw - cw) / GREATEST(abs(iw), 1e-9), 6) AS improvement, round(dw, 6) AS day_wape,
       COALESCE(dw <= 0.04, false) AS meets_day_target, COALESCE(cw < iw, false) AS beats_baseline,
       COALESCE(dw <= 0.04, false) AND COALESCE((iw - cw) / GREATEST(abs(iw), 1e-9) > 0.02, false) AS releasable
FROM (SELECT COUNT(*) AS n, {O.wape_sql(p='pred_seasonal')} AS iw, {O.wape_sql()} AS cw FROM scored WHERE split = 'test'),
     (SELECT {O.wape_sql()} AS dw FROM scored WHERE split = 'test' AND snapshot_day = 15)""", SPLIT))
def q_release_gate(spark, sf_dir):
    """The promotion gate with its day-15 target and the baseline condition."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return release_gate(test, SEASONAL, PREDICTION)


def _with_planted_rows(df):
    """Every fifth facility reports negative payments on day 15."""
    bad = (F.substring("facility_id", 5, 3).cast("int") % 5 == 0) & (F.col("snapshot_day") == 15)
    return df.withColumn("month_to_date_payments", F.when(bad, F.lit(-5.0)).otherwise(F.col("month_to_date_payments")))


_PLANTED = "CAST(substr(facility_id, 5, 3) AS INT) % 5 = 0 AND snapshot_day = 15 AND split = 'test'"
_BAD_TARGET = "NOT COALESCE(actual_month_end_net_revenue > 0, false)"


@register("contract_failure_drift", W(f"""
SELECT "column", round(r, 6) AS reference_rate, round(c, 6) AS current_rate, c - r > 0.01 AS drifted FROM (
  SELECT "column", COALESCE(AVG(bad) FILTER (WHERE split = 'train'), 0.0) AS r, COALESCE(AVG(bad) FILTER (WHERE split = 'test'), 0.0) AS c, SUM(bad) AS n FROM (
    SELECT split, '*' AS "column", CASE WHEN ({_PLANTED}) OR {_BAD_TARGET} THEN 1.0 ELSE 0.0 END AS bad FROM split
    UNION ALL SELECT split, 'month_to_date_payments', CASE WHEN {_PLANTED} THEN 1.0 ELSE 0.0 END FROM split
    UNION ALL SELECT split, 'actual_month_end_net_revenue', CASE WHEN {_BAD_TARGET} THEN 1.0 ELSE 0.0 END FROM split)
  WHERE split IN ('train', 'test') GROUP BY "column")
WHERE "column" = '*' OR r > 0 OR c > 0""", SPLIT))
def q_contract_failure_drift(spark, sf_dir):
    """Contract failures of the test block, with planted negative payments, against the training block."""
    split = blocked_temporal_split(snapshots(spark, sf_dir))
    return D.contract_failure_drift(split.train, _with_planted_rows(split.test))


@register("schema_changes", W("""
SELECT batch, added, removed, changed, added || removed || changed <> '' AS retrain FROM (VALUES
  ('2', '', '', ''), ('3', 'days_elapsed_text', 'days_elapsed', ''), ('4', 'days_elapsed', 'days_elapsed_text', 'month_to_date_payments')) v(batch, added, removed, changed)
WHERE (SELECT COUNT(*) FROM split WHERE split = 'train') > 0""", SPLIT))
def q_schema_changes(spark, sf_dir):
    """Schemas of four accepted batches, kept in a ledger: equal, a renamed column, a column of another type."""
    split = blocked_temporal_split(snapshots(spark, sf_dir))
    path = scratch_path(spark, "fingerprints")
    batches = [split.train, split.validation, split.test.withColumnRenamed("days_elapsed", "days_elapsed_text"),
               split.test.withColumn("month_to_date_payments", F.col("month_to_date_payments").cast("string"))]
    for k, frame in enumerate(batches, 1):
        D.keep_fingerprint(frame, str(k), path)
    return D.schema_changes(spark.read.parquet(path))


# ------------------------------------------------- checkable facts of the model queries
# A trained model has no SQL; these rows state what must hold of its full result.
_N_NUMERIC = 43  # numeric model inputs: operational, historical and derived columns
_N_FEATURES = (f"(SELECT {_N_NUMERIC} + COUNT(DISTINCT service_line_group) + COUNT(DISTINCT generic_payer_group) "
               "+ COUNT(DISTINCT encounter_class_group) FROM split WHERE split = 'train')")


def _ordered(df, key: str, value: str):
    """n, and whether ``value`` is never negative and falls in the order of the rows as returned."""
    rows = [r[value] for r in df.collect()]  # one row per feature
    falls = all(a >= b for a, b in zip(rows, rows[1:]))
    return len(rows), falls, all(v >= 0 for v in rows), sum(rows)


@register("train_candidates_facts", W(f"SELECT * FROM ({SEL_TABLE})", SPLIT))
def q_train_candidates_facts(spark, sf_dir):
    """The baselines' rows of the training run's ranking equal SQL."""
    return QUERIES["train_candidates"](spark, sf_dir).where(F.col("model").isin("naive_prior", "seasonal_naive")).select("model", *M.METRIC_NAMES)


@register("candidate_metrics_by_day_facts", W("""
SELECT model, snapshot_day, COUNT(*) AS n FROM scored, (VALUES ('naive_prior'), ('seasonal_naive'), ('elastic_net'), ('hist_gradient_boosting')) m(model)
WHERE split = 'test' GROUP BY model, snapshot_day""", SPLIT))
def q_candidate_metrics_by_day_facts(spark, sf_dir):
    """Every candidate scores every test row of every day."""
    return QUERIES["candidate_metrics_by_day"](spark, sf_dir).select("model", "snapshot_day", "n")


@register("tune_grid_facts", "SELECT 4 AS n_settings, true AS best_is_least, CAST(0.38 AS DOUBLE) AS rates")
def q_tune_grid_facts(spark, sf_dir):
    """Four settings; exactly the least WAPE is marked best."""
    g = QUERIES["tune_grid"](spark, sf_dir)
    low = F.min("wape")
    return g.agg(F.count(F.lit(1)).cast("int").alias("n_settings"), (F.min(F.when(F.col("is_best"), F.col("wape"))) == low).alias("best_is_least"),
                 F.round(F.sum("learning_rate"), 2).alias("rates"))


@register("permutation_importance_facts", W(f"SELECT {_N_FEATURES} AS n_features, true AS sorted", SPLIT))
def q_permutation_importance_facts(spark, sf_dir):
    n, falls, *_ = _ordered(QUERIES["permutation_importance"](spark, sf_dir), "feature", "importance_mean")
    return spark.createDataFrame([(n, falls)], "n_features bigint, sorted boolean")


@register("native_importance_facts", W(f"SELECT {_N_FEATURES} AS n_features, true AS sorted, true AS non_negative, CAST(1.0 AS DOUBLE) AS total", SPLIT))
def q_native_importance_facts(spark, sf_dir):
    n, falls, positive, total = _ordered(QUERIES["native_importance"](spark, sf_dir), "feature", "importance")
    return spark.createDataFrame([(n, falls, positive, round(total, 6))], "n_features bigint, sorted boolean, non_negative boolean, total double")


@register("shap_global_facts", "SELECT 12 AS n_features, true AS sorted, true AS non_negative")
def q_shap_global_facts(spark, sf_dir):
    n, falls, positive, _ = _ordered(QUERIES["shap_global"](spark, sf_dir), "feature", "mean_abs_shap")
    return spark.createDataFrame([(n, falls, positive)], "n_features int, sorted boolean, non_negative boolean")


@register("score_interval_facts", W("""
SELECT facility_id, COUNT(*) AS n, true AS inside, true AS spread FROM split WHERE split = 'test' GROUP BY facility_id""", SPLIT))
def q_score_interval_facts(spark, sf_dir):
    """Every test row has lower <= prediction <= upper and a spread of at least 0."""
    p = F.col("predicted_month_end_net_revenue")
    return QUERIES["score_interval"](spark, sf_dir).groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and((F.col("prediction_lower") <= p) & (p <= F.col("prediction_upper"))).alias("inside"),
        F.bool_and(F.col("prediction_std") >= 0).alias("spread"))


@register("interval_coverage_facts", W("SELECT snapshot_day, COUNT(*) AS n, true AS share FROM split WHERE split = 'test' GROUP BY snapshot_day", SPLIT))
def q_interval_coverage_facts(spark, sf_dir):
    return QUERIES["interval_coverage"](spark, sf_dir).select("snapshot_day", "n", F.col("coverage").between(0, 1).alias("share"))


@register("backtest_models_facts", ORACLE_SQL["backtest_baselines"])
def q_backtest_models_facts(spark, sf_dir):
    """The baselines' WAPE on every expanding fold equals SQL."""
    b = QUERIES["backtest_models"](spark, sf_dir).where("kind = 'expanding'")
    wape = lambda m: F.max(F.when(F.col("model") == m, F.col("wape")))
    return b.groupBy("fold_id").agg(F.max("n").alias("n"), wape("naive_prior").alias("wape_naive_prior"), wape("seasonal_naive").alias("wape_seasonal_naive"))


def _one_candidate(name: str):
    def q(spark, sf_dir):
        from closecast.plans.training import train_all_concurrent

        split = blocked_temporal_split(snapshots(spark, sf_dir))
        cache, results = train_all_concurrent(split, ModelConfig(candidates=[name]))
        cache.release()
        return M.reported(results[name].metrics.select(F.lit(name).alias("model"), "n", *M.METRIC_NAMES))
    q.__doc__ = f"L8/L9: the default candidate {name}, fitted on the training block and measured on the test block."
    return q


for _name in ("gradient_boosting", "xgboost", "random_forest"):
    register(f"train_{_name}")(_one_candidate(_name))
