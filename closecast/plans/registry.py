"""Registered queries (one per operator) and their DuckDB oracle statements.

Every query reads the driver's source tables (through the snapshot table
Spark derives from ``lineitem``/``supplier``/``nation``/``region``, or the
text tables directly) and runs over all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.functions import textscan as ts
from closecast.operators import contracts as C
from closecast.operators import drift as D
from closecast.operators import kpi as K
from closecast.operators import metrics as M
from closecast.operators import profiling as PR
from closecast.operators import scoring as B
from closecast.operators import selection as S
from closecast.operators import splits as T
from closecast.operators.baselines import fallback_mean
from closecast.operators.features import LeakageSafeFeatures, fit_statistics, with_derived
from closecast.operators.joins import eval_coverage, predictions_vs_actuals
from closecast.plans import oracle_sql as O
from closecast.plans.common import SEASONAL, baseline_scored, naive_bundle, snapshots, split_tagged
from closecast.plans.snapshots import build_snapshots
from closecast.schema import (
    ALL_COLUMNS,
    DERIVED,
    DIMENSIONS,
    HISTORICAL,
    KEYS,
    OPERATIONAL,
    PREDICTION,
    TARGET,
)
from closecast.sources import snapshot_io as IO
from closecast.sources.tables import ensure_parallelism, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

Y, P = TARGET, PREDICTION
W = O.with_snapshots
SPLIT = O.SPLIT_CTES.strip()


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _cols(names) -> str:
    return ", ".join(names)


# ---------------------------------------------------------------- sources / G11
@register("snapshots_from_facts", W(O.SNAPSHOT_SELECT))
def q_snapshots_from_facts(spark, sf_dir):
    return build_snapshots(spark, sf_dir)


@register("read_snapshots", W(O.SNAPSHOT_SELECT))
def q_read_snapshots(spark, sf_dir):
    """A1/A2: the materialised Parquet table read back with the declared schema."""
    return snapshots(spark, sf_dir)


@register("write_snapshots_csv", W(O.SNAPSHOT_SELECT))
def q_write_snapshots_csv(spark, sf_dir):
    """A2/A1 via CSV: written partitioned by month, read back with the schema."""
    path = IO.scratch_path(spark, "snapshots_csv").replace(".parquet", ".csv")
    IO.write_snapshots(snapshots(spark, sf_dir), path)
    return IO.read_snapshots(spark, path)


@register("dataset_sample", W(f"SELECT * FROM snapshots ORDER BY {_cols(KEYS)} LIMIT 50"))
def q_dataset_sample(spark, sf_dir):
    return IO.dataset_sample(snapshots(spark, sf_dir), 50)


INVALID_BODY = f"""SELECT {_cols([
    "CASE WHEN rn = 1 THEN 'FACILITY_1' ELSE facility_id END AS facility_id",
    "accounting_month", "snapshot_date",
    "CASE WHEN rn = 3 THEN CAST(99 AS BIGINT) ELSE snapshot_day END AS snapshot_day",
    *[c for c in ALL_COLUMNS[4:] if c != TARGET],
    f"CASE WHEN rn = 2 THEN -1000.0 ELSE {TARGET} END AS {TARGET}"])}
FROM (SELECT *, row_number() OVER (ORDER BY {_cols(KEYS)}) AS rn FROM snapshots) x WHERE rn <= 20"""
INVALID_CTE = f"invalid AS ({INVALID_BODY})"
_INVALID_SQL = W(INVALID_BODY)


@register("invalid_sample", _INVALID_SQL)
def q_invalid_sample(spark, sf_dir):
    return IO.invalid_sample(snapshots(spark, sf_dir), 20)


@register("month_index", W("""
SELECT accounting_month, CAST(date_diff('month', (SELECT MIN(strptime(accounting_month, '%Y-%m')) FROM snapshots), strptime(accounting_month, '%Y-%m')) AS BIGINT) AS month_idx,
       CAST(substr(accounting_month, 1, 4) AS BIGINT) AS year, CAST(substr(accounting_month, 6, 2) AS BIGINT) AS month
FROM (SELECT DISTINCT accounting_month FROM snapshots)"""))
def q_month_index(spark, sf_dir):
    """The consecutive month list with its position."""
    return PR.month_index(snapshots(spark, sf_dir))


@register("month_history", W("""
SELECT facility_id, accounting_month, target,
  MAX(target) OVER (w RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prior_month,
  MAX(target) OVER (w RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS prior_year_same_month,
  CAST(SUM(CAST(target AS DECIMAL(20,2))) OVER (w RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE)
    / NULLIF(COUNT(target) OVER (w RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS rolling_3,
  CAST(SUM(CAST(target AS DECIMAL(20,2))) OVER (w RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS DOUBLE)
    / NULLIF(COUNT(target) OVER (w RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING), 0) AS rolling_6,
  CAST(SUM(CAST(target AS DECIMAL(20,2))) OVER (w RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS DOUBLE)
    / NULLIF(COUNT(target) OVER (w RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING), 0) AS rolling_12
FROM (SELECT facility_id, accounting_month, MIN(actual_month_end_net_revenue) AS target,
             CAST(substr(accounting_month, 1, 4) AS INT) * 12 + CAST(substr(accounting_month, 6, 2) AS INT) AS m
      FROM snapshots GROUP BY facility_id, accounting_month)
WINDOW w AS (PARTITION BY facility_id ORDER BY m)"""))
def q_month_history(spark, sf_dir):
    """Lag and trailing-mean history over a facility-month series."""
    series = PR.facility_month_series(snapshots(spark, sf_dir)).withColumnRenamed("first_target", "target")
    return PR.month_history(series, "target")


@register("calendar_features", W("""
SELECT accounting_month, month, quarter, month_sin, month_cos FROM (
  SELECT accounting_month, CAST(substr(accounting_month, 6, 2) AS BIGINT) AS month,
         CAST((CAST(substr(accounting_month, 6, 2) AS BIGINT) - 1) // 3 + 1 AS BIGINT) AS quarter,
         CASE WHEN round(sin(2 * pi() * (CAST(substr(accounting_month, 6, 2) AS BIGINT) - 1) / 12), 6) = 0 THEN 0.0
              ELSE round(sin(2 * pi() * (CAST(substr(accounting_month, 6, 2) AS BIGINT) - 1) / 12), 6) END AS month_sin,
         CASE WHEN round(cos(2 * pi() * (CAST(substr(accounting_month, 6, 2) AS BIGINT) - 1) / 12), 6) = 0 THEN 0.0
              ELSE round(cos(2 * pi() * (CAST(substr(accounting_month, 6, 2) AS BIGINT) - 1) / 12), 6) END AS month_cos
  FROM (SELECT DISTINCT accounting_month FROM snapshots))"""))
def q_calendar_features(spark, sf_dir):
    """Month, quarter, seasonal sine / cosine from the month label."""
    return PR.calendar_features(snapshots(spark, sf_dir))


@register("period_progress", W("""
SELECT snapshot_date,
  CAST(day(d) AS DOUBLE) AS days_elapsed,
  CAST((day(d) // 7) * 5 + day(d) % 7
       - (CASE WHEN (12 - (isodow(date_trunc('month', d)) - 1)) % 7 < day(d) % 7 THEN 1 ELSE 0 END)
       - (CASE WHEN (13 - (isodow(date_trunc('month', d)) - 1)) % 7 < day(d) % 7 THEN 1 ELSE 0 END) AS DOUBLE)
    AS business_days_elapsed,
  CAST(day(last_day(d)) - day(d) AS DOUBLE) AS remaining_days
FROM (SELECT DISTINCT snapshot_date, CAST(snapshot_date AS DATE) AS d FROM snapshots)"""))
def q_period_progress(spark, sf_dir):
    """Elapsed / business / remaining days from the snapshot date."""
    return PR.period_progress(snapshots(spark, sf_dir))


@register("snapshot_expand", W("""
SELECT facility_id, accounting_month, COUNT(*) AS n_snapshots,
       CAST(MIN(snapshot_day) AS BIGINT) AS first_day, CAST(MAX(snapshot_day) AS BIGINT) AS last_day
FROM snapshots GROUP BY facility_id, accounting_month"""))
def q_snapshot_expand(spark, sf_dir):
    """Every facility-month carries one row per configured day."""
    return (snapshots(spark, sf_dir).groupBy("facility_id", "accounting_month")
            .agg(F.count(F.lit(1)).alias("n_snapshots"), F.min("snapshot_day").alias("first_day"),
                 F.max("snapshot_day").alias("last_day")))


# ---------------------------------------------------------------- contracts
def _contract_union(table: str, require_target: bool = True) -> str:
    """UNION ALL of one SELECT per rule; ``ord`` keeps the declared rule order."""
    parts = []
    key_sel = ", ".join(f"CAST({k} AS VARCHAR) AS {k}" for k in KEYS)
    ord_ = 0
    for r in C.contract_rules(require_target):
        if not r.nullable:
            ord_ += 1
            isnan = "" if r.column in O.NON_DOUBLE else f" OR isnan({r.column})"
            parts.append(f"SELECT {key_sel}, '{r.column}' AS \"column\", 'not_nullable' AS \"check\", "
                         f"CAST(NULL AS VARCHAR) AS failure_case, {ord_} AS ord FROM {table} "
                         f"WHERE {r.column} IS NULL{isnan}")
        if r.predicate is None:
            continue
        ord_ += 1
        v = r.column
        kind = r.check.split("(")[0]
        if kind == "str_matches":
            cond = f"NOT regexp_matches({v}, '{r.predicate.split('RLIKE ')[1].strip(chr(39))}')"
        elif kind == "in_range":
            lo, hi = (int(x) for x in r.check[len("in_range("):-1].split(","))
            cond = f"NOT ({v} BETWEEN {lo} AND {hi})"
        elif kind == "greater_than_or_equal_to":
            cond = f"NOT ({v} >= 0)"
        else:
            cond = f"NOT ({v} > 0)"
        notnull = f"{v} IS NOT NULL" + ("" if v in O.NON_DOUBLE else f" AND NOT isnan({v})")
        parts.append(f"SELECT {key_sel}, '{r.column}' AS \"column\", '{r.check.replace(chr(39), chr(39) * 2)}' AS \"check\", "
                     f"CAST({v} AS VARCHAR) AS failure_case, {ord_} AS ord FROM {table} WHERE {notnull} AND {cond}")
    return "\nUNION ALL\n".join(parts)


def _contract_sql(table: str, extra_cte: str = "") -> str:
    body = f"SELECT {_cols(KEYS)}, \"column\", \"check\", failure_case FROM ({_contract_union(table)})"
    return W(body, extra_cte)


@register("contract_failures", _contract_sql("snapshots"))
def q_contract_failures(spark, sf_dir):
    """C1/C1a-c: long failure table of the derived snapshot table."""
    return C.contract_failures(snapshots(spark, sf_dir))


@register("contract_invalid_sample", _contract_sql("invalid", INVALID_CTE))
def q_contract_invalid_sample(spark, sf_dir):
    """C1 on the planted-fault sample: exactly the three faults."""
    return C.contract_failures(IO.invalid_sample(snapshots(spark, sf_dir), 20))


def _leak_sql(table: str) -> str:
    return f"""
SELECT 'unparseable_date' AS rule, COUNT(*) FILTER (WHERE try_strptime(snapshot_date, '%Y-%m-%d') IS NULL) AS violations,
       CASE WHEN COUNT(*) FILTER (WHERE try_strptime(snapshot_date, '%Y-%m-%d') IS NULL) > 0
            THEN 'some values of snapshot_date are not dates' END AS message FROM {table}
UNION ALL
SELECT 'day_matches_date', CASE WHEN u > 0 THEN NULL ELSE v END,
       CASE WHEN u = 0 AND v > 0 THEN 'snapshot_day is not the day of the month in snapshot_date' END FROM (
  SELECT COUNT(*) FILTER (WHERE try_strptime(snapshot_date, '%Y-%m-%d') IS NULL) AS u,
         COUNT(*) FILTER (WHERE NOT COALESCE(day(try_strptime(snapshot_date, '%Y-%m-%d')) = snapshot_day, false)) AS v
  FROM {table})
UNION ALL
SELECT 'date_in_month', CASE WHEN u > 0 THEN NULL ELSE v END,
       CASE WHEN u = 0 AND v > 0 THEN 'snapshot_date lies in another month than accounting_month' END FROM (
  SELECT COUNT(*) FILTER (WHERE try_strptime(snapshot_date, '%Y-%m-%d') IS NULL) AS u,
         COUNT(*) FILTER (WHERE NOT COALESCE(strftime(try_strptime(snapshot_date, '%Y-%m-%d'), '%Y-%m') = accounting_month, false)) AS v
  FROM {table})
UNION ALL
SELECT 'days_elapsed', COUNT(*) FILTER (WHERE NOT COALESCE(CAST(days_elapsed AS DOUBLE) = CAST(snapshot_day AS DOUBLE), false)),
       CASE WHEN COUNT(*) FILTER (WHERE NOT COALESCE(CAST(days_elapsed AS DOUBLE) = CAST(snapshot_day AS DOUBLE), false)) > 0
            THEN 'days_elapsed is not snapshot_day: the row may know later days' END FROM {table}
UNION ALL
SELECT 'target_constant', COUNT(*),
       CASE WHEN COUNT(*) > 0 THEN 'target varies inside facility-month [' ||
         (SELECT string_agg(o, ', ' ORDER BY o) FROM (
            SELECT '(''' || facility_id || ''', ''' || accounting_month || ''')' AS o
            FROM (SELECT facility_id, accounting_month FROM {table}
                  WHERE facility_id IS NOT NULL AND accounting_month IS NOT NULL
                  GROUP BY facility_id, accounting_month
                  HAVING MIN(CASE WHEN isnan({TARGET}) THEN NULL ELSE {TARGET} END)
                      <> MAX(CASE WHEN isnan({TARGET}) THEN NULL ELSE {TARGET} END)
                  ORDER BY facility_id, accounting_month LIMIT 3)))
         || ']' END
FROM (SELECT facility_id, accounting_month FROM {table}
      WHERE facility_id IS NOT NULL AND accounting_month IS NOT NULL
      GROUP BY facility_id, accounting_month
      HAVING MIN(CASE WHEN isnan({TARGET}) THEN NULL ELSE {TARGET} END)
          <> MAX(CASE WHEN isnan({TARGET}) THEN NULL ELSE {TARGET} END))"""


@register("leakage_checks", W(_leak_sql("snapshots")))
def q_leakage_checks(spark, sf_dir):
    """One row per leakage rule on the derived snapshots."""
    return C.leakage_report(snapshots(spark, sf_dir))


@register("leakage_invalid_sample", W(_leak_sql("invalid"), INVALID_CTE))
def q_leakage_invalid_sample(spark, sf_dir):
    return C.leakage_report(IO.invalid_sample(snapshots(spark, sf_dir), 20))


_FIRST_MONTH = "(SELECT MIN(accounting_month) FROM snapshots)"
_SHIFTED_CTE = f"""shifted AS (SELECT * REPLACE (
  CASE WHEN accounting_month = {_FIRST_MONTH} AND snapshot_day = 10
       THEN strftime(CAST(strptime(snapshot_date, '%Y-%m-%d') AS DATE) + 40, '%Y-%m-%d') ELSE snapshot_date END AS snapshot_date,
  CASE WHEN accounting_month = {_FIRST_MONTH} AND snapshot_day = 15 THEN {TARGET} + 1 ELSE {TARGET} END AS {TARGET}) FROM snapshots)"""
_GARBLED_CTE = f"""garbled AS (SELECT * REPLACE (
  CASE WHEN accounting_month = {_FIRST_MONTH} AND snapshot_day = 10 THEN 'soon' ELSE snapshot_date END AS snapshot_date) FROM snapshots)"""


def _planted(spark, sf_dir):
    snaps = snapshots(spark, sf_dir)
    first = F.lit(snaps.agg(F.min("accounting_month")).first()[0])
    return snaps, (F.col("accounting_month") == first) & (F.col("snapshot_day") == 10), (F.col("accounting_month") == first) & (F.col("snapshot_day") == 15)


@register("leakage_planted_dates", W(_leak_sql("shifted"), _SHIFTED_CTE))
def q_leakage_planted_dates(spark, sf_dir):
    """C2, C3, C5 on the whole table with dates moved into another month and targets changed."""
    snaps, day10, day15 = _planted(spark, sf_dir)
    moved = F.date_format(F.date_add(F.to_date("snapshot_date"), 40), "yyyy-MM-dd")
    return C.leakage_report(snaps.withColumns({
        "snapshot_date": F.when(day10, moved).otherwise(F.col("snapshot_date")), TARGET: F.when(day15, F.col(TARGET) + 1).otherwise(F.col(TARGET))}))


@register("leakage_planted_text", W(_leak_sql("garbled"), _GARBLED_CTE))
def q_leakage_planted_text(spark, sf_dir):
    """C6 on the whole table with dates that do not parse."""
    snaps, day10, _ = _planted(spark, sf_dir)
    return C.leakage_report(snaps.withColumn("snapshot_date", F.when(day10, F.lit("soon")).otherwise(F.col("snapshot_date"))))


@register("coerced_failures", W(f"""
SELECT {_cols(KEYS)}, '{TARGET}' AS "column", 'coerce_dtype(''double'')' AS "check", 'n/a' AS failure_case FROM snapshots
WHERE snapshot_day = 10 AND {TARGET} > 0
UNION ALL SELECT {_cols(KEYS)}, '{TARGET}', 'not_nullable', NULL FROM snapshots WHERE snapshot_day = 10 AND {TARGET} > 0"""))
def q_coerced_failures(spark, sf_dir):
    """C1 on text input: every value as text, the target unreadable on day 10, so also missing (rows whose target meets the contract)."""
    snaps = snapshots(spark, sf_dir).where(F.col(TARGET) > 0)
    text = snaps.select(*[F.col(c).cast("string").alias(c) for c in snaps.columns]).withColumn(
        TARGET, F.when(F.col("snapshot_day") == "10", F.lit("n/a")).otherwise(F.col(TARGET)))
    found = C.coerced_contract_failures(text)
    return found.select(*[F.col(k).cast(dict(snaps.dtypes)[k]).alias(k) for k in KEYS], "column", "check", "failure_case")


@register("orphan_facts", """
SELECT COUNT(*) AS n_facts, COUNT(*) FILTER (WHERE s.s_suppkey IS NULL) AS n_without_supplier
FROM lineitem l LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l.l_suppkey = s.s_suppkey""")
def q_orphan_facts(spark, sf_dir):
    """G11 check row: facts whose supplier is unknown, which the snapshots leave out. Counted by key before the join."""
    keys = read_table(spark, sf_dir, "lineitem", ["l_suppkey"]).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey"]).distinct()
    j = keys.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_facts"),
                 F.coalesce(F.sum(F.when(F.col("s_suppkey").isNull(), F.col("n"))), F.lit(0)).alias("n_without_supplier"))


@register("quarantine_ledger", W(f"""
SELECT accounting_month, COUNT(*) AS n_input, COUNT(*) FILTER (WHERE {TARGET} > 0) AS n_good, COUNT(*) FILTER (WHERE NOT ({TARGET} > 0)) AS n_bad
FROM snapshots GROUP BY accounting_month"""))
def q_quarantine_ledger(spark, sf_dir):
    """By month, accepted + quarantined = input (the only rule that the derived snapshots break is target > 0)."""
    snaps = snapshots(spark, sf_dir)
    path = IO.scratch_path(spark, "quarantine")
    good, _ = C.accepted_rows(snaps, path)
    by = lambda df, name: df.groupBy("accounting_month").agg(F.count(F.lit(1)).alias(name))
    both = by(snaps, "n_input").join(by(good, "n_good"), "accounting_month", "left").join(by(spark.read.parquet(path), "n_bad"), "accounting_month", "left")
    return both.select("accounting_month", "n_input", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_good", "n_bad")])


@register("quarantine_invalid_sample", W(f"""
SELECT {_cols(KEYS)}, string_agg("column" || ':' || "check", ';' ORDER BY ord) AS contract_failures
FROM ({_contract_union('invalid')}) GROUP BY {_cols(KEYS)}""", INVALID_CTE))
def q_quarantine_invalid_sample(spark, sf_dir):
    """Bad rows of the planted-fault sample with their failure list."""
    _, bad = C.quarantine(IO.invalid_sample(snapshots(spark, sf_dir), 20))
    return bad.select(*[F.col(k).cast("string").alias(k) for k in KEYS], "contract_failures")


@register("quarantine_summary", W("""
SELECT CASE WHEN actual_month_end_net_revenue > 0 AND month_to_date_payments >= 0 THEN 'good' ELSE 'bad' END AS status,
       COUNT(*) AS n_rows FROM snapshots GROUP BY 1"""))
def q_quarantine_summary(spark, sf_dir):
    """C9 on the derived snapshots: good / bad row counts."""
    good, bad = C.quarantine(snapshots(spark, sf_dir))
    g = good.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("good").alias("status"), "n_rows")
    b = bad.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("bad").alias("status"), "n_rows")
    return g.unionByName(b).where("n_rows > 0")


# ---------------------------------------------------------------- projections
@register("derived_ratios", W(f"""
SELECT {_cols(KEYS)},
  month_to_date_payments / NULLIF(month_to_date_gross_charges + 1.0, 0) AS mtd_collection_ratio,
  month_to_date_denials / NULLIF(month_to_date_gross_charges + 1.0, 0) AS mtd_denial_ratio,
  month_to_date_contractual_adjustments / NULLIF(month_to_date_gross_charges + 1.0, 0) AS mtd_adjustment_ratio,
  month_to_date_gross_charges / NULLIF(days_elapsed + 1.0, 0) AS mtd_gross_run_rate,
  days_elapsed / NULLIF(days_elapsed + remaining_days, 0) AS fraction_month_elapsed
FROM snapshots"""))
def q_derived_ratios(spark, sf_dir):
    """Derived partial-month ratios."""
    return with_derived(snapshots(spark, sf_dir)).select(*KEYS, *DERIVED)


@register("cutoff_filter", W(f"SELECT {_cols(KEYS)}, {TARGET} FROM snapshots WHERE snapshot_day = 15"))
def q_cutoff_filter(spark, sf_dir):
    """Rows at the day-15 cutoff (falls back to the demo day if absent)."""
    return B.cutoff_filter(snapshots(spark, sf_dir), 15).select(*KEYS, TARGET)


@register("gross_to_net", W(f"""
SELECT COUNT(*) AS n_rows, COUNT(CASE WHEN {TARGET} <> 0 THEN 1 END) AS n_ratios,
       round(AVG(CASE WHEN {TARGET} <> 0 THEN month_to_date_gross_charges / {TARGET} END), 3) AS average_gross_to_net_ratio
FROM snapshots WHERE snapshot_day = 15"""))
def q_gross_to_net(spark, sf_dir):
    """Average gross-to-net ratio at the cutoff over all rows."""
    return B.gross_to_net(snapshots(spark, sf_dir), 15)


@register("gross_to_net_rows", W(f"""
SELECT facility_id, accounting_month, snapshot_day, round(month_to_date_gross_charges, 2) AS gross_charges, round({TARGET}, 2) AS net_revenue,
       round(CASE WHEN {TARGET} <> 0 THEN month_to_date_gross_charges / {TARGET} END, 3) AS gross_to_net_ratio
FROM snapshots WHERE snapshot_day = 15"""))
def q_gross_to_net_rows(spark, sf_dir):
    """The per-row items at the cutoff, all rows."""
    return B.gross_to_net_rows(snapshots(spark, sf_dir), 15)


# ---------------------------------------------------------------- baselines / joins
@register("naive_prior", W(f"SELECT {_cols(KEYS)}, {P} FROM scored", SPLIT))
def q_naive_prior(spark, sf_dir):
    """L1: prior-month baseline, fitted on the training block, all rows scored."""
    return baseline_scored(spark, sf_dir).select(*KEYS, P)


@register("seasonal_naive", W(f"SELECT {_cols(KEYS)}, pred_seasonal AS {P} FROM scored", SPLIT))
def q_seasonal_naive(spark, sf_dir):
    """L2: same month last year baseline."""
    return baseline_scored(spark, sf_dir).select(*KEYS, F.col(SEASONAL).alias(P))


@register("baseline_fallback_mean", W("SELECT fallback FROM fb", SPLIT))
def q_baseline_fallback_mean(spark, sf_dir):
    """Training-target mean used where the history column is missing."""
    return fallback_mean(T.blocked_temporal_split(snapshots(spark, sf_dir)).train)


@register("batch_score", W(f"""
SELECT {_cols(KEYS)}, {P}, 'naive_prior' AS model_name, '0.1.0' AS model_version, 'baseline-run' AS run_id,
       CAST(snapshot_day AS BIGINT) AS cutoff_day, '2001-11-01T00:00:00.000000+00:00' AS scored_at
FROM scored""", SPLIT))
def q_batch_score(spark, sf_dir):
    """Keys + prediction + lineage (one scored-at per batch)."""
    bundle = naive_bundle(spark, sf_dir)
    return B.batch_score(bundle, snapshots(spark, sf_dir), scored_at="2001-11-01 00:00:00")


@register("predictions_vs_actuals", W(f"""
SELECT {_cols([f'p.{k}' for k in KEYS])}, p.{P}, a.{Y} FROM (SELECT {_cols(KEYS)}, {P} FROM scored) p
JOIN (SELECT {_cols(KEYS)}, {Y} FROM snapshots) a ON {' AND '.join(f'p.{k} = a.{k}' for k in KEYS)}""", SPLIT))
def q_predictions_vs_actuals(spark, sf_dir):
    """Scored predictions inner-joined to actuals on the four keys."""
    bundle = naive_bundle(spark, sf_dir)
    snaps = snapshots(spark, sf_dir)
    preds = B.batch_score(bundle, snaps.drop(TARGET), scored_at="2001-11-01 00:00:00")
    return predictions_vs_actuals(preds, snaps).select(*KEYS, P, Y)


@register("eval_coverage", W(f"""
SELECT {_cols(KEYS)}, 'prediction_without_actual' AS gap FROM snapshots WHERE NOT ({Y} > 0)"""))
def q_eval_coverage(spark, sf_dir):
    """Predictions with no valid (contract-passing) actual, and vice versa."""
    snaps = snapshots(spark, sf_dir)
    preds = B.batch_score(naive_bundle(spark, sf_dir), snaps, scored_at="2001-11-01 00:00:00")
    actuals = snaps.where(F.col(Y) > 0)
    return eval_coverage(preds, actuals)


@register("score_cutoff_preview", W(f"""
SELECT {_cols(KEYS)}, round({P}, 2) AS predicted, round({Y}, 2) AS actual,
       round(CASE WHEN {Y} <> 0 THEN abs({Y} - {P}) / abs({Y}) END, 4) AS abs_pct_error
FROM scored WHERE split = 'test' AND snapshot_day = 15""", SPLIT))
def q_score_cutoff_preview(spark, sf_dir):
    """Test block at the cutoff, scored, with per-row APE."""
    snaps = snapshots(spark, sf_dir)
    test = T.blocked_temporal_split(snaps).test
    at = B.cutoff_filter(test, 15)
    preds = B.batch_score(naive_bundle(spark, sf_dir), at, cutoff_day=15)
    return B.score_cutoff_rows(predictions_vs_actuals(preds, at))


@register("score_cutoff_block", W(f"""
SELECT COUNT(*) AS n, round({O.wape_sql()}, 6) AS wape FROM scored WHERE split = 'test' AND snapshot_day = 15""", SPLIT))
def q_score_cutoff_block(spark, sf_dir):
    """WAPE of the whole test block at the cutoff."""
    at = B.cutoff_filter(T.blocked_temporal_split(snapshots(spark, sf_dir)).test, 15)
    preds = B.batch_score(naive_bundle(spark, sf_dir), at, cutoff_day=15)
    return B.cutoff_wape(predictions_vs_actuals(preds, at)).withColumn("wape", F.round("wape", 6))


@register("latest_snapshot", W(f"""
SELECT {_cols(ALL_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY facility_id, accounting_month ORDER BY snapshot_day DESC) AS rn
  FROM snapshots WHERE snapshot_day <= 16) WHERE rn = 1"""))
def q_latest_snapshot(spark, sf_dir):
    """Newest snapshot per facility-month on or before day 16."""
    return B.latest_snapshot(snapshots(spark, sf_dir), 16)


# ---------------------------------------------------------------- metrics
@register("metrics_overall", W(f"SELECT {O.metric_sql()} FROM scored", SPLIT))
def q_metrics_overall(spark, sf_dir):
    """M1-M8 on every scored row."""
    return M.reported(M.metrics_overall(baseline_scored(spark, sf_dir)))


@register("metrics_by_facility", W(f"SELECT facility_id, {O.metric_sql()} FROM scored GROUP BY facility_id", SPLIT))
def q_metrics_by_facility(spark, sf_dir):
    return M.reported(M.metrics_by_facility(baseline_scored(spark, sf_dir)))


@register("metrics_by_day", W(f"SELECT snapshot_day, {O.metric_sql()} FROM scored GROUP BY snapshot_day", SPLIT))
def q_metrics_by_day(spark, sf_dir):
    return M.reported(M.metrics_by_day(baseline_scored(spark, sf_dir)))


_CUBE_SQL = f"""
SELECT CASE GROUPING(facility_id, snapshot_day) WHEN 3 THEN 'overall' WHEN 1 THEN 'facility' ELSE 'snapshot_day' END AS level,
       facility_id, snapshot_day, {O.metric_sql()}
FROM scored GROUP BY GROUPING SETS ((), (facility_id), (snapshot_day))"""


@register("metrics_cube", W(_CUBE_SQL, SPLIT))
def q_metrics_cube(spark, sf_dir):
    """The three metric tables in one grouping-sets aggregate."""
    return M.reported(M.metrics_cube(baseline_scored(spark, sf_dir)))


@register("continuous_evaluation", W(_CUBE_SQL, SPLIT))
def q_continuous_evaluation(spark, sf_dir):
    """K4: predictions joined to closed-month actuals -> one metrics cube."""
    from closecast.plans.evaluation import continuous_evaluation

    snaps = snapshots(spark, sf_dir)
    preds = B.batch_score(naive_bundle(spark, sf_dir), snaps.drop(TARGET), scored_at="2001-11-01 00:00:00")
    return M.reported(continuous_evaluation(preds, snaps).cube)


# ---------------------------------------------------------------- profiling
@register("dataset_overview", W(f"""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT facility_id) AS n_facilities, COUNT(DISTINCT accounting_month) AS n_months,
  (SELECT string_agg(f, ',' ORDER BY f) FROM (SELECT DISTINCT facility_id AS f FROM snapshots)) AS facilities,
  (SELECT string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) FROM (SELECT DISTINCT snapshot_day AS d FROM snapshots)) AS snapshot_days,
  MIN(accounting_month) AS first_month, MAX(accounting_month) AS last_month,
  CAST(SUM(CAST({Y} AS DECIMAL(38,4))) AS DOUBLE) / CAST(COUNT({Y}) AS DOUBLE) AS target_mean,
  MIN({Y}) AS target_min, MAX({Y}) AS target_max
FROM snapshots"""))
def q_dataset_overview(spark, sf_dir):
    """Rows, facilities, months, days and target range."""
    return PR.dataset_overview(snapshots(spark, sf_dir))


@register("facility_month_series", W(f"""
SELECT facility_id, accounting_month, MIN({Y}) AS first_target FROM snapshots GROUP BY facility_id, accounting_month"""))
def q_facility_month_series(spark, sf_dir):
    """One target per facility-month (all facilities)."""
    return PR.facility_month_series(snapshots(spark, sf_dir))


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL"
             + ("" if c in O.NON_DOUBLE else f" OR isnan({c})") + ") AS missing_count, COUNT(*) AS n FROM snapshots"
             for c in ALL_COLUMNS]
    return ("SELECT \"column\", missing_count, round(CAST(missing_count AS DOUBLE) / n, 4) AS missing_pct FROM ("
            + " UNION ALL ".join(parts) + ") WHERE missing_count > 0")


@register("missing_profile", W(_missing_sql()))
def q_missing_profile(spark, sf_dir):
    """Per column with missing values: count and share."""
    return PR.missing_profile(snapshots(spark, sf_dir))


@register("outlier_count", W("""
SELECT round(p99, 4) AS p99_gross, COUNT(*) FILTER (WHERE month_to_date_gross_charges > 1.5 * p99) AS n_outliers
FROM snapshots, (SELECT quantile_cont(month_to_date_gross_charges, 0.99) AS p99 FROM snapshots) q GROUP BY p99"""))
def q_outlier_count(spark, sf_dir):
    """Rows with gross charges above 1.5 x the 99th percentile."""
    return PR.outlier_count(snapshots(spark, sf_dir))


def _corr_sql(top: int = 10) -> str:
    parts = [f"SELECT '{c}' AS feature, corr({c}, {Y}) AS r FROM snapshots" for c in OPERATIONAL]
    return (f"SELECT feature, round(r, 4) AS corr_with_target FROM ({' UNION ALL '.join(parts)}) "
            f"ORDER BY abs(r) DESC NULLS LAST, feature LIMIT {top}")


@register("target_correlation", W(_corr_sql()))
def q_target_correlation(spark, sf_dir):
    """Pearson r of each operational column with the target, top 10 by |r|."""
    return PR.target_correlation(snapshots(spark, sf_dir), top=10)


def _skew_sql(top: int = 10) -> str:
    parts = [f"SELECT '{c}' AS feature, CASE WHEN COUNT({c}) >= 3 THEN skewness({c}) END AS s FROM snapshots"
             for c in OPERATIONAL]
    return (f"SELECT feature, round(s, 3) AS skewness FROM ({' UNION ALL '.join(parts)}) "
            f"ORDER BY abs(s) DESC NULLS LAST, feature LIMIT {top}")


@register("feature_skewness", W(_skew_sql()))
def q_feature_skewness(spark, sf_dir):
    """Bias-corrected sample skewness, top 10 by |skew|."""
    return PR.feature_skewness(snapshots(spark, sf_dir), top=10)


@register("distinct_months", W("SELECT DISTINCT accounting_month FROM snapshots"))
def q_distinct_months(spark, sf_dir):
    """M21/S9."""
    return snapshots(spark, sf_dir).select("accounting_month").distinct()


# ---------------------------------------------------------------- splits
@register("split_blocked", W(f"SELECT {_cols(KEYS)}, split FROM scored", SPLIT))
def q_split_blocked(spark, sf_dir):
    """Blocked temporal split as a column."""
    return T.with_split_column(snapshots(spark, sf_dir)).select(*KEYS, "split")


@register("split_summary", W("""
SELECT split, COUNT(*) AS n_rows, COUNT(DISTINCT accounting_month) AS n_months, MIN(accounting_month) AS first_month,
       MAX(accounting_month) AS last_month, string_agg(DISTINCT accounting_month, ',' ORDER BY accounting_month) AS months
FROM scored GROUP BY split""", SPLIT))
def q_split_summary(spark, sf_dir):
    """T4."""
    return T.split_summary(snapshots(spark, sf_dir))


def _folds_sql(kind: str, h: int = 4, k: int = 3) -> str:
    if kind == "rolling":
        lo = "GREATEST(0, e - mt)"
    else:
        lo = "0"
    start = ("GREATEST(%d, m - %d)" % (h, k * h)) if kind == "rolling" else \
        ("CASE WHEN m - %d < 1 THEN %d ELSE m - %d END" % (k * h, h, k * h))
    return f"""
, mi AS (SELECT accounting_month, CAST(dense_rank() OVER (ORDER BY accounting_month) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT accounting_month FROM snapshots)),
mc AS (SELECT COUNT(*) AS m FROM mi),
folds AS (SELECT CAST(f.i AS INTEGER) AS fold_id, {start} AS mt, {start} + f.i * {h} AS e, m FROM mc, range({k}) f(i)),
cal AS (
  SELECT fold_id, 'train' AS role, mi.accounting_month FROM folds, mi
    WHERE e + {h} <= m AND mi.idx >= {lo} AND mi.idx < e
  UNION ALL
  SELECT fold_id, 'validation', mi.accounting_month FROM folds, mi
    WHERE e + {h} <= m AND mi.idx >= e AND mi.idx < e + {h}
)
SELECT fold_id, role, COUNT(*) AS n_rows, COUNT(DISTINCT s.accounting_month) AS n_months,
       MIN(s.accounting_month) AS first_month, MAX(s.accounting_month) AS last_month
FROM snapshots s JOIN cal ON s.accounting_month = cal.accounting_month GROUP BY fold_id, role"""


def _with_tail(tail: str) -> str:
    body = tail.split("\nSELECT fold_id, role, COUNT", 1)
    return W("SELECT fold_id, role, COUNT" + body[1], body[0].lstrip("\n, "))


@register("folds_rolling", _with_tail(_folds_sql("rolling")))
def q_folds_rolling(spark, sf_dir):
    """Rolling-origin folds (fold calendar joined to the rows)."""
    return T.backtest_summary(snapshots(spark, sf_dir), "rolling")


@register("folds_expanding", _with_tail(_folds_sql("expanding")))
def q_folds_expanding(spark, sf_dir):
    """Expanding-window folds."""
    return T.backtest_summary(snapshots(spark, sf_dir), "expanding")


# ---------------------------------------------------------------- features
_NUMERIC = OPERATIONAL + HISTORICAL + DERIVED
_DERIVED_SQL = {
    "mtd_collection_ratio": "{q}month_to_date_payments / NULLIF({q}month_to_date_gross_charges + 1.0, 0)",
    "mtd_denial_ratio": "{q}month_to_date_denials / NULLIF({q}month_to_date_gross_charges + 1.0, 0)",
    "mtd_adjustment_ratio": "{q}month_to_date_contractual_adjustments / NULLIF({q}month_to_date_gross_charges + 1.0, 0)",
    "mtd_gross_run_rate": "{q}month_to_date_gross_charges / NULLIF({q}days_elapsed + 1.0, 0)",
    "fraction_month_elapsed": "{q}days_elapsed / NULLIF({q}days_elapsed + {q}remaining_days, 0)",
}


def _feat_value(c: str, q: str = "") -> str:
    """Finite value of numeric input ``c`` (derived ones computed); ``q`` qualifies columns."""
    expr = _DERIVED_SQL[c].format(q=q) if c in _DERIVED_SQL else f"CAST({q}{c} AS DOUBLE)"
    return f"CASE WHEN isfinite({expr}) THEN {expr} END"


_MEDIAN_CTES = SPLIT + ",\nmed AS (SELECT " + ", ".join(
    f"COALESCE({O.spark_percentile_sql(f'list_sort(list({_feat_value(c)}) FILTER (WHERE {_feat_value(c)} IS NOT NULL))', '0.5')}, 0.0) AS {c}"
    for c in _NUMERIC) + " FROM split WHERE split = 'train')"


@register("train_medians", W(
    "SELECT feature, median FROM (UNPIVOT med ON " + ", ".join(_NUMERIC) + " INTO NAME feature VALUE median)",
    _MEDIAN_CTES))
def q_train_medians(spark, sf_dir):
    """Exact medians of finite values per numeric input, training block only."""
    return PR.train_medians(T.blocked_temporal_split(snapshots(spark, sf_dir)).train)


@register("train_categories", W(
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, string_agg(DISTINCT CAST({d} AS VARCHAR), ',' ORDER BY CAST({d} AS VARCHAR)) AS categories "
        f"FROM split WHERE split = 'train' AND {d} IS NOT NULL" for d in DIMENSIONS), SPLIT))
def q_train_categories(spark, sf_dir):
    """Sorted categories per dimension, training block only."""
    stats = fit_statistics(T.blocked_temporal_split(snapshots(spark, sf_dir)).train.select(*DIMENSIONS))
    parts = [stats.select(F.lit(d).alias("dimension"), F.array_join(f"cats__{d}", ",").alias("categories"))
             for d in DIMENSIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _feature_transform_sql() -> str:
    cols = [f"COALESCE({_feat_value(c, 's.')}, med.{c}) AS {c}" for c in _NUMERIC]
    keys = [f"s.{k}" for k in KEYS]
    return W(f"SELECT {_cols(keys)}, {_cols(cols)} FROM snapshots s, med", _MEDIAN_CTES)


@register("feature_transform", _feature_transform_sql())
def q_feature_transform(spark, sf_dir):
    """Builder fitted on train, applied to every row (numeric block; ``feature_onehot`` has the other)."""
    snaps = snapshots(spark, sf_dir)
    model = LeakageSafeFeatures(outputCol="").fit(T.blocked_temporal_split(snaps).train)
    return model.transform(snaps.drop(TARGET)).select(*KEYS, *_NUMERIC)


@register("feature_onehot", W(f"""
SELECT {_cols([f's.{k}' for k in KEYS])}, concat_ws(',', {', '.join(
    f"CASE WHEN s.{d} IN (SELECT {d} FROM split WHERE split = 'train') THEN '{d}__' || s.{d} END" for d in DIMENSIONS)}) AS hot,
       {' + '.join(f"(SELECT COUNT(DISTINCT {d}) FROM split WHERE split = 'train')" for d in DIMENSIONS)} AS n_columns
FROM snapshots s""", SPLIT))
def q_feature_onehot(spark, sf_dir):
    """the one-hot block of every row: names of its set columns, and how many columns there are."""
    snaps = snapshots(spark, sf_dir)
    model = LeakageSafeFeatures(outputCol="").fit(T.blocked_temporal_split(snaps).train)
    names = [n for n in model.feature_names() if n not in model.medians]
    hot = F.concat_ws(",", *[F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in names])
    return model.transform(snaps.drop(TARGET)).select(*KEYS, hot.alias("hot"), F.lit(len(names)).cast("bigint").alias("n_columns"))


# ---------------------------------------------------------------- selection / KPI
SEL_TABLE = f"""
SELECT 'naive_prior' AS model, {O.metric_sql().split(',', 1)[1]} FROM scored WHERE split = 'test'
UNION ALL
SELECT 'seasonal_naive' AS model, {O.metric_sql(p='pred_seasonal').split(',', 1)[1]} FROM scored WHERE split = 'test'"""


@register("comparison_table", W(f"""
SELECT *, row_number() OVER (ORDER BY wape ASC NULLS LAST, model) AS rank,
       row_number() OVER (ORDER BY wape ASC NULLS LAST, model) = 1 AS is_champion
FROM ({SEL_TABLE})""", SPLIT))
def q_comparison_table(spark, sf_dir):
    """Baseline candidates on the test block, ranked by WAPE."""
    return M.reported(S.ranked(PR.baseline_comparison(baseline_scored(spark, sf_dir))))


@register("select_champion", W(f"""
SELECT MAX(CASE WHEN rank = 1 THEN model END) AS champion, MAX(CASE WHEN rank = 2 THEN model END) AS challenger,
       round(MAX(CASE WHEN rank = 1 THEN wape END), 6) AS champion_score, round(MAX(CASE WHEN rank = 2 THEN wape END), 6) AS challenger_score,
       COALESCE((MAX(CASE WHEN rank = 1 THEN wape END) - MAX(CASE WHEN rank = 2 THEN wape END))
         / GREATEST(abs(MAX(CASE WHEN rank = 1 THEN wape END)), 1e-9) > 0.02, false) AS challenger_promotable
FROM (SELECT *, row_number() OVER (ORDER BY wape ASC NULLS LAST, model) AS rank FROM ({SEL_TABLE}))""", SPLIT))
def q_select_champion(spark, sf_dir):
    """L12."""
    s = S.selection_frame(PR.baseline_comparison(baseline_scored(spark, sf_dir)))
    return s.withColumns({c: F.round(c, 6) for c in ("champion_score", "challenger_score")})


@register("promotion_gate", W(f"""
SELECT n, round(iw, 6) AS incumbent_wape, round(cw, 6) AS candidate_wape,
       round((iw - cw) / GREATEST(abs(iw), 1e-9), 6) AS improvement,
       COALESCE((iw - cw) / GREATEST(abs(iw), 1e-9) > 0.02, false) AS promote
FROM (SELECT COUNT(*) AS n, {O.wape_sql(p='pred_seasonal')} AS iw, {O.wape_sql()} AS cw
      FROM scored WHERE split = 'test')""", SPLIT))
def q_promotion_gate(spark, sf_dir):
    """Incumbent (seasonal) vs candidate (prior-month) on the same test rows."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return S.promotion_gate(test, SEASONAL, P)


_KPI_CTE = SPLIT + """,
tgt AS (SELECT * FROM (VALUES ('Day 10 (early read)', 10, 0.07, NULL), ('Day 15 (primary)', 15, 0.04, 0.05),
                              ('Day 21 (second)', 21, 0.04, NULL)) t(checkpoint, snapshot_day, wape_max, fac_max)),
byday AS (SELECT snapshot_day, """ + O.wape_sql() + """ AS wape FROM scored WHERE split = 'test' GROUP BY snapshot_day)"""

_K1 = """SELECT checkpoint, CAST(t.snapshot_day AS BIGINT) AS snapshot_day, 'wape' AS metric, round(wape, 4) AS value,
       CAST(wape_max AS DOUBLE) AS target, COALESCE(wape <= wape_max, false) AS met, round(wape_max - wape, 4) AS margin
FROM byday b JOIN tgt t ON b.snapshot_day = t.snapshot_day"""


@register("kpi_checkpoints", W(_K1, _KPI_CTE))
def q_kpi_checkpoints(spark, sf_dir):
    """K1: day 10 / 15 / 21 WAPE against their ceilings (test block)."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return K.checkpoint_targets(M.metrics_by_day(test))


@register("kpi_scorecard", W(_K1 + f"""
UNION ALL
SELECT 'Beat manual analyst baseline', CAST(NULL AS BIGINT), 'wape', round(cw, 4), round(bw, 4),
       COALESCE(cw < bw, false), round(bw - cw, 4)
FROM (SELECT {O.wape_sql()} AS cw, {O.wape_sql(p='pred_seasonal')} AS bw FROM scored WHERE split = 'test')""", _KPI_CTE))
def q_kpi_scorecard(spark, sf_dir):
    """K2/K3: checkpoint rows + beat-the-baseline row."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return K.scorecard_for(test, baseline_pred=SEASONAL)


@register("facility_targets", W(f"""
SELECT checkpoint, facility_id, CAST(s.snapshot_day AS BIGINT) AS snapshot_day, COUNT(*) AS n, round({O.wape_sql()}, 4) AS value,
       CAST(MAX(fac_max) AS DOUBLE) AS target, COALESCE({O.wape_sql()} <= MAX(fac_max), false) AS met,
       round(MAX(fac_max) - {O.wape_sql()}, 4) AS margin
FROM scored s JOIN tgt t ON s.snapshot_day = t.snapshot_day
WHERE split = 'test' AND fac_max IS NOT NULL GROUP BY checkpoint, facility_id, s.snapshot_day""", _KPI_CTE))
def q_facility_targets(spark, sf_dir):
    """K5: per-facility ceiling at day 15 (declared in the reference, evaluated here)."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return K.facility_targets(test)


# ---------------------------------------------------------------- drift
_DRIFT_COLS = [c for c in OPERATIONAL + HISTORICAL + [TARGET]]


def _drift_ctes(cols: list[str]) -> str:
    levels = D.quantile_levels()
    lv = ", ".join(repr(q) for q in levels)
    stack = lambda side, block: " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, '{side}' AS side FROM split WHERE split {block} "
        f"AND {c} IS NOT NULL AND NOT isnan({c})" for c in cols)
    q = "l[1]"
    return SPLIT + f""",
lng AS ({stack('ref', "= 'train'")} UNION ALL {stack('cur', "= 'test'")}),
srt AS (SELECT feature, list_sort(list(x)) AS l FROM lng WHERE side = 'ref' GROUP BY feature),
qs AS (SELECT feature, list_sort(list_distinct([{', '.join(O.spark_percentile_sql('l', repr(x)) for x in levels)}])) AS edges FROM srt),
ed AS (SELECT feature, len(edges) AS n_edges, edges[2:len(edges) - 1] AS inner FROM qs),
cnt AS (SELECT l.feature, len(list_filter(e.inner, lambda v: v <= l.x)) AS bin,
               COUNT(*) FILTER (WHERE side = 'ref') AS expected, COUNT(*) FILTER (WHERE side = 'cur') AS actual
        FROM lng l JOIN ed e ON l.feature = e.feature GROUP BY ALL),
tot AS (SELECT feature, COUNT(*) FILTER (WHERE side = 'ref') AS n_ref, COUNT(*) FILTER (WHERE side = 'cur') AS n_cur
        FROM lng GROUP BY feature),
bgrid AS (SELECT feature, n_edges, CAST(unnest(range(0, n_edges - 1)) AS INTEGER) AS bin FROM ed WHERE n_edges >= 2),
bins AS (SELECT g.feature, g.bin, COALESCE(c.expected, 0) AS expected, COALESCE(c.actual, 0) AS actual, t.n_ref, t.n_cur
         FROM bgrid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin JOIN tot t ON g.feature = t.feature),
psi AS (SELECT feature, SUM((greatest(actual / n_cur, 1e-6) - greatest(expected / n_ref, 1e-6))
                            * ln(greatest(actual / n_cur, 1e-6) / greatest(expected / n_ref, 1e-6))) AS psi
        FROM bins GROUP BY feature),
allf AS (SELECT * FROM (VALUES {', '.join(f"('{c}')" for c in cols)}) v(feature)),
rep AS (SELECT a.feature, CASE WHEN COALESCE(t.n_ref, 0) = 0 OR COALESCE(t.n_cur, 0) = 0 THEN NULL
                               ELSE COALESCE(p.psi, 0.0) END AS psi
        FROM allf a LEFT JOIN tot t ON a.feature = t.feature LEFT JOIN psi p ON a.feature = p.feature)"""


def _status(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'unknown' WHEN {x} < 0.1 THEN 'stable' "
            f"WHEN {x} < 0.25 THEN 'moderate' ELSE 'drifted' END")


def _drift_frames(spark, sf_dir):
    tagged = split_tagged(spark, sf_dir)
    return tagged.where("split = 'train'"), tagged.where("split = 'test'")


@register("psi_gross_charges", W("SELECT feature, round(psi, 6) AS psi FROM rep",
                                  _drift_ctes(["month_to_date_gross_charges"])))
def q_psi(spark, sf_dir):
    """PSI of month-to-date gross charges, training vs test block."""
    ref, cur = _drift_frames(spark, sf_dir)
    return D.psi_by_feature(ref, cur, ["month_to_date_gross_charges"]).select(
        "feature", F.round("psi", 6).alias("psi"))


@register("histogram_counts", W("SELECT feature, bin, expected, actual FROM bins",
                                 _drift_ctes(["month_to_date_gross_charges"])))
def q_histogram_counts(spark, sf_dir):
    """Reference-decile bin counts on both sides."""
    ref, cur = _drift_frames(spark, sf_dir)
    return D.binned_counts(ref, cur, ["month_to_date_gross_charges"]).select("feature", "bin", "expected", "actual")


@register("drift_report", W(f"SELECT feature, round(psi, 6) AS psi, {_status('psi')} AS status FROM rep",
                            _drift_ctes(_DRIFT_COLS)))
def q_drift_report(spark, sf_dir):
    """PSI of every numeric column, training vs test block, one pass."""
    ref, cur = _drift_frames(spark, sf_dir)
    return D.drift_report(ref, cur, _DRIFT_COLS).select("feature", F.round("psi", 6).alias("psi"), "status")


@register("drift_summary", W(f"""
SELECT COUNT(*) AS n_features, round(MAX(psi), 6) AS max_psi, {_status('MAX(psi)')} AS status FROM rep""",
                             _drift_ctes(_DRIFT_COLS)))
def q_drift_summary(spark, sf_dir):
    ref, cur = _drift_frames(spark, sf_dir)
    s = D.drift_summary(D.drift_report(ref, cur, _DRIFT_COLS))
    return s.select("n_features", F.round("max_psi", 6).alias("max_psi"), "status")


@register("js_distance", W("""
SELECT a.feature, CASE WHEN COALESCE(t.n_ref, 0) = 0 OR COALESCE(t.n_cur, 0) = 0 THEN NULL ELSE round(COALESCE(j.js, 0.0), 6) END AS js_distance
FROM allf a LEFT JOIN tot t ON a.feature = t.feature LEFT JOIN (
SELECT feature, sqrt(greatest(SUM(
   0.5 * CASE WHEN expected > 0 THEN (expected / n_ref) * ln((expected / n_ref) / ((expected / n_ref + actual / n_cur) / 2)) ELSE 0 END
 + 0.5 * CASE WHEN actual > 0 THEN (actual / n_cur) * ln((actual / n_cur) / ((expected / n_ref + actual / n_cur) / 2)) ELSE 0 END), 0)) AS js
FROM bins GROUP BY feature) j ON a.feature = j.feature""", _drift_ctes(_DRIFT_COLS)))
def q_js_distance(spark, sf_dir):
    """Jensen-Shannon distance on the PSI bins."""
    ref, cur = _drift_frames(spark, sf_dir)
    return D.js_distance(ref, cur, _DRIFT_COLS).select("feature", F.round("js_distance", 6).alias("js_distance"))


def _dq_sql() -> str:
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL" + ("" if c in O.NON_DOUBLE else f" OR isnan({c})")
        + f" THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'train') AS r, AVG(CASE WHEN {c} IS NULL"
        + ("" if c in O.NON_DOUBLE else f" OR isnan({c})") + " THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test') AS c FROM split"
        for c in ALL_COLUMNS)
    new = " UNION ALL ".join(
        f"SELECT 'new_categories', '{d}', 0.0, CAST(COUNT(*) AS DOUBLE), COUNT(*) > 0 FROM "
        f"(SELECT DISTINCT CAST({d} AS VARCHAR) AS k FROM split WHERE split = 'test' AND {d} IS NOT NULL "
        f"EXCEPT SELECT DISTINCT CAST({d} AS VARCHAR) FROM split WHERE split = 'train' AND {d} IS NOT NULL)"
        for d in DIMENSIONS)
    return (f"SELECT 'missing_share' AS \"check\", \"column\", round(r, 6) AS reference_value, round(c, 6) AS current_value, "
            f"c - r > 0.05 AS drifted FROM ({miss}) UNION ALL {new}")


@register("data_quality_drift", W(_dq_sql(), SPLIT))
def q_data_quality_drift(spark, sf_dir):
    """Missingness change per column and unseen categories, train vs test."""
    ref, cur = _drift_frames(spark, sf_dir)
    return D.data_quality_drift(ref, cur, ALL_COLUMNS)


def _retrain_sql() -> str:
    levels = D.quantile_levels()
    pct = ", ".join(O.spark_percentile_sql("l", repr(x)) for x in levels)
    p = "predicted_month_end_net_revenue"
    ctes = SPLIT + f""",
rl AS (SELECT list_sort(list({p})) AS l FROM scored WHERE split = 'train' AND {p} IS NOT NULL AND NOT isnan({p})),
ed AS (SELECT list_sort(list_distinct([{pct}])) AS edges FROM rl),
inn AS (SELECT edges[2:len(edges) - 1] AS inner, len(edges) - 1 AS nb FROM ed),
rc AS (SELECT len(list_filter(inn.inner, lambda v: v <= s.{p})) AS bin, COUNT(*) AS expected
       FROM scored s, inn WHERE s.split = 'train' AND s.{p} IS NOT NULL AND NOT isnan(s.{p}) GROUP BY 1),
nr AS (SELECT SUM(expected) AS n_ref FROM rc),
cc AS (SELECT s.accounting_month, len(list_filter(inn.inner, lambda v: v <= s.{p})) AS bin, COUNT(*) AS actual
       FROM scored s, inn WHERE s.split <> 'train' AND s.{p} IS NOT NULL AND NOT isnan(s.{p}) GROUP BY 1, 2),
nc AS (SELECT accounting_month, COUNT(*) AS n_cur FROM scored
       WHERE split <> 'train' AND {p} IS NOT NULL AND NOT isnan({p}) GROUP BY 1),
gr AS (SELECT g.accounting_month, CAST(unnest(range(0, inn.nb)) AS INTEGER) AS bin
       FROM (SELECT DISTINCT accounting_month FROM scored WHERE split <> 'train') g, inn),
mp AS (SELECT gr.accounting_month, SUM(
          (greatest(COALESCE(cc.actual, 0) / nc.n_cur, 1e-6) - greatest(COALESCE(rc.expected, 0) / nr.n_ref, 1e-6))
          * ln(greatest(COALESCE(cc.actual, 0) / nc.n_cur, 1e-6) / greatest(COALESCE(rc.expected, 0) / nr.n_ref, 1e-6)))
          AS psi
       FROM gr LEFT JOIN rc ON gr.bin = rc.bin LEFT JOIN cc ON gr.accounting_month = cc.accounting_month AND gr.bin = cc.bin
       LEFT JOIN nc ON gr.accounting_month = nc.accounting_month, nr GROUP BY gr.accounting_month),
mon AS (SELECT accounting_month, COUNT(*) AS n, {O.wape_sql()} AS wape,
               (SELECT {O.wape_sql()} FROM scored WHERE split = 'train') AS ref_wape
        FROM scored WHERE split <> 'train' GROUP BY accounting_month),
j AS (SELECT mon.*, mp.psi, COALESCE(mon.wape > 1.1 * mon.ref_wape, false) AS accuracy_breach,
             COALESCE(mp.psi >= 0.25, false) AS drift_breach
      FROM mon LEFT JOIN mp ON mon.accounting_month = mp.accounting_month)"""
    body = """
SELECT accounting_month, n, round(wape, 6) AS wape, round(ref_wape, 6) AS reference_wape, round(psi, 6) AS prediction_psi,
       accuracy_breach, drift_breach, accuracy_breach OR drift_breach AS breach,
       CAST(SUM(CAST(accuracy_breach OR drift_breach AS INTEGER)) OVER (ORDER BY accounting_month
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS breaches_last_3,
       SUM(CAST(accuracy_breach OR drift_breach AS INTEGER)) OVER (ORDER BY accounting_month
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 3 AS retrain
FROM j"""
    return W(body, ctes)


@register("retrain_trigger", _retrain_sql())
def q_retrain_trigger(spark, sf_dir):
    """Monthly accuracy vs the training-period level; retrain after 3 breaching months in a row."""
    return PR.retrain_trigger(baseline_scored(spark, sf_dir))


# ---------------------------------------------------------------- text scan
# fixed values, written out here on their own so that a wrong engine pattern shows
_SQL_PATTERNS = [
    ("azure_subscription_guid", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
    ("connection_string", r"(?i)(AccountKey|SharedAccessKey|Password)=[^;\s]+"),
    ("bearer_token", r"Bearer\s+[A-Za-z0-9\-\._~\+\/]+=*"),
    ("sas_token", r"(?i)[?&]sig=[^&\s]+"),
    ("email", r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"),
    ("us_phone", r"\b\(?\d{3}\)?[\s.\-]\d{3}[\s.\-]\d{4}\b"),
]


def _find_sql(col: str) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN regexp_matches({col}, '{pat}') THEN '{name}' END" for name, pat in _SQL_PATTERNS) + ")"


def _redact_sql(col: str) -> str:
    out = col
    for _, pat in _SQL_PATTERNS:
        out = f"regexp_replace({out}, '{pat}', '[REDACTED]', 'g')"
    return out


@register("contains_secret", "SELECT doc_id, (" + " OR ".join(
    f"COALESCE(regexp_matches(text, '{p}'), false)" for _, p in _SQL_PATTERNS) + ") AS has_secret FROM documents")
def q_contains_secret(spark, sf_dir):
    """Y1 over every document (whole texts)."""
    docs = ensure_parallelism(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return docs.select("doc_id", ts.contains_secret(F.col("text")).alias("has_secret"))


@register("redact_documents", f"SELECT doc_id, {_redact_sql('text')} AS redacted FROM documents")
def q_redact_documents(spark, sf_dir):
    """Y2 over every document."""
    docs = ensure_parallelism(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return docs.select("doc_id", ts.redact(F.col("text")).alias("redacted"))


@register("scan_findings", f"SELECT doc_id, findings FROM (SELECT doc_id, {_find_sql('text')} AS findings FROM documents) "
                           "WHERE findings <> ''")
def q_scan_findings(spark, sf_dir):
    """Pattern names found per document (documents with findings)."""
    docs = ensure_parallelism(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return ts.with_findings(docs, "text")


_CORPUS_SQL = f"""
SELECT source, item_id, findings FROM (
  SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS item_id, {_find_sql('text')} AS findings FROM documents
  UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), {_find_sql('html')} FROM pages
  UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), {_find_sql('text')} FROM conversations
) WHERE findings <> ''"""


@register("scan_corpus", _CORPUS_SQL)
def q_scan_corpus(spark, sf_dir):
    """Scan documents, pages and conversation turns; report texts with findings."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"]).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    return ts.scan_corpus([
        ("documents", ensure_parallelism(read_table(spark, sf_dir, "documents", ["doc_id", "text"])), "doc_id", "text"),
        ("pages", ensure_parallelism(read_table(spark, sf_dir, "pages", ["page_id", "html"])), "page_id", "html"),
        ("conversations", ensure_parallelism(conv), "id", "text"),
    ])


@register("scan_verdict", f"""
SELECT COUNT(*) FILTER (WHERE source = 'pages' OR (source = 'documents' AND item_id = '22')) AS n_allowed,
       COUNT(*) FILTER (WHERE NOT (source = 'pages' OR (source = 'documents' AND item_id = '22'))) AS n_violations,
       COUNT(*) FILTER (WHERE NOT (source = 'pages' OR (source = 'documents' AND item_id = '22'))) = 0 AS passed
FROM ({_CORPUS_SQL})""")
def q_scan_verdict(spark, sf_dir):
    """The scan's verdict with an allow-list (one source, one item)."""
    return ts.scan_verdict(q_scan_corpus(spark, sf_dir), ["pages"], [("documents", "22")])


# ---------------------------------------------------------------- flagship
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """facts -> snapshots -> naive baseline on the last 4 closed months ->
    metrics by day -> checkpoint targets + beat-the-baseline scorecard."""
    test = baseline_scored(spark, sf_dir).where(F.col("split") == "test")
    return K.scorecard_for(test, baseline_pred=SEASONAL)


register("flagship_scorecard", ORACLE_SQL["kpi_scorecard"])(flagship)



# ---------------------------------------------------------------- backtest / preview / sinks
_FOLD_CTES = _folds_sql("expanding").split("\nSELECT fold_id, role, COUNT", 1)[0].lstrip("\n, ")


@register("backtest_baselines", W(f"""
SELECT f.fold_id, COUNT(*) AS n,
       round({O.wape_sql(p='COALESCE(CASE WHEN isfinite(s.prior_month_net_revenue) THEN s.prior_month_net_revenue END, f.fallback)')}, 6) AS wape_naive_prior,
       round({O.wape_sql(p='COALESCE(CASE WHEN isfinite(s.prior_year_same_month_net_revenue) THEN s.prior_year_same_month_net_revenue END, f.fallback)')}, 6) AS wape_seasonal_naive
FROM snapshots s JOIN cal c ON s.accounting_month = c.accounting_month AND c.role = 'validation'
JOIN (SELECT c2.fold_id, COALESCE(CAST(SUM(CAST(t.{Y} AS DECIMAL(38,4))) AS DOUBLE) / CAST(COUNT(t.{Y}) AS DOUBLE), 0.0) AS fallback
      FROM snapshots t JOIN cal c2 ON t.accounting_month = c2.accounting_month AND c2.role = 'train'
      WHERE isfinite(t.{Y}) GROUP BY c2.fold_id) f ON f.fold_id = c.fold_id
GROUP BY f.fold_id""", _FOLD_CTES))
def q_backtest_baselines(spark, sf_dir):
    """T5: fit the two baselines on each expanding fold's training months and
    score its validation months; one WAPE per fold and model."""
    from closecast.operators.baselines import exact_mean
    from closecast.operators.metrics import metric_exprs

    tagged = T.backtest_folds(snapshots(spark, sf_dir), "expanding")
    fb = (tagged.where("role = 'train'").groupBy("fold_id")
          .agg(F.coalesce(exact_mean(Y), F.lit(0.0)).alias("fallback")))
    val = tagged.where("role = 'validation'").join(F.broadcast(fb), "fold_id")
    from closecast.functions.columns import finite_or_null

    val = val.withColumn("p_naive", F.coalesce(finite_or_null(F.col("prior_month_net_revenue")), F.col("fallback"))) \
             .withColumn("p_seasonal", F.coalesce(finite_or_null(F.col("prior_year_same_month_net_revenue")),
                                                  F.col("fallback")))
    return val.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(metric_exprs(Y, "p_naive")["wape"], 6).alias("wape_naive_prior"),
        F.round(metric_exprs(Y, "p_seasonal")["wape"], 6).alias("wape_seasonal_naive"))


_PREVIEW_RATIOS = ["mtd_collection_ratio", "mtd_denial_ratio", "mtd_adjustment_ratio",
                   "fraction_month_elapsed", "mtd_gross_run_rate"]


@register("feature_preview", W(f"""
SELECT {len([c for c in ALL_COLUMNS if c in DIMENSIONS + OPERATIONAL + HISTORICAL])} AS n_raw,
       {len(_NUMERIC)} + (SELECT COUNT(*) FROM (""" + " UNION ".join(
    f"SELECT DISTINCT '{d}' AS d, CAST({d} AS VARCHAR) AS c FROM split WHERE split = 'train' AND {d} IS NOT NULL"
    for d in DIMENSIONS) + f""")) AS n_engineered,
       {_cols(f"round(COALESCE({_feat_value(c, 'x.')}, med.{c}), 4) AS example_{c}" for c in _PREVIEW_RATIOS)}
FROM (SELECT * FROM split WHERE split = 'train' ORDER BY {_cols(KEYS)} LIMIT 1) x, med""", _MEDIAN_CTES))
def q_feature_preview(spark, sf_dir):
    """raw / engineered feature counts and the derived ratios of the first
    training row (key order)."""
    snaps = snapshots(spark, sf_dir)
    train = T.blocked_temporal_split(snaps).train
    model = LeakageSafeFeatures(outputCol="").fit(train)
    raw = [c for c in DIMENSIONS + OPERATIONAL + HISTORICAL if c in snaps.columns]
    first = model.transform(train.orderBy(*KEYS).limit(1))
    return first.select(
        F.lit(len(raw)).alias("n_raw"), F.lit(len(model.feature_names())).alias("n_engineered"),
        *[F.round(c, 4).alias(f"example_{c}") for c in _PREVIEW_RATIOS])


_RAW_INPUTS = [c for c in DIMENSIONS + OPERATIONAL + HISTORICAL if c in ALL_COLUMNS]


@register("feature_preview_columns", W(f"""
SELECT 'raw' AS kind, position, name, CAST(NULL AS DOUBLE) AS example
FROM (VALUES {_cols(f"({i}, '{c}')" for i, c in enumerate(_RAW_INPUTS))}) r(position, name)
UNION ALL
SELECT 'engineered', e.position, e.name, round(e.example, 4) FROM (
  """ + " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS name, COALESCE({_feat_value(c, 'x.')}, med.{c}) AS example FROM x, med"
                            for i, c in enumerate(_NUMERIC)) + f"""
  UNION ALL SELECT {len(_NUMERIC) - 1} + row_number() OVER (ORDER BY h.dim, h.category), h.name || '__' || h.category, CAST(COALESCE(h.first_value = h.category, false) AS DOUBLE) FROM (
    """ + " UNION ALL ".join(f"SELECT DISTINCT {i} AS dim, '{d}' AS name, CAST(s.{d} AS VARCHAR) AS category, CAST(x.{d} AS VARCHAR) AS first_value "
                              f"FROM split s, x WHERE s.split = 'train' AND s.{d} IS NOT NULL" for i, d in enumerate(DIMENSIONS)) + """) h) e""",
    _MEDIAN_CTES + f", x AS (SELECT * FROM split WHERE split = 'train' ORDER BY {_cols(KEYS)} LIMIT 1)"))
def q_feature_preview_columns(spark, sf_dir):
    """the raw and the engineered columns by name and place, each engineered one with its value in the first training row (key order)."""
    snaps = snapshots(spark, sf_dir)
    train = T.blocked_temporal_split(snaps).train
    model = LeakageSafeFeatures(outputCol="").fit(train)
    listed = lambda kind, pairs: F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("position"), F.lit(c).alias("name"),
                                                    F.round(v, 4).alias("example")) for i, (c, v) in enumerate(pairs)])
    raw = listed("raw", [(c, F.lit(None).cast("double")) for c in _RAW_INPUTS if c in snaps.columns])
    engineered = listed("engineered", [(c, F.col(f"`{c}`")) for c in model.feature_names()])
    return model.transform(train.orderBy(*KEYS).limit(1)).select(F.inline(F.concat(raw, engineered)))


@register("predictions_sink", ORACLE_SQL["batch_score"])
def q_predictions_sink(spark, sf_dir):
    """A5: scored predictions written partitioned by month and cutoff day
    (dynamic overwrite), read back in the prediction schema."""
    preds = B.batch_score(naive_bundle(spark, sf_dir), snapshots(spark, sf_dir), scored_at="2001-11-01 00:00:00")
    root = IO.scratch_path(spark, "lake").replace(".parquet", "")
    path = IO.write_predictions(preds, root)
    back = spark.read.parquet(path)
    return back.select(*[F.col(c).cast(t) for c, t in preds.dtypes])


def _evaluation_job(spark, sf_dir) -> str:
    """K4 + A7 as a job over every snapshot; the folder of its four reports."""
    from closecast.plans.evaluation import run_continuous_evaluation

    snaps = snapshots(spark, sf_dir)
    preds = B.batch_score(naive_bundle(spark, sf_dir), snaps.drop(TARGET), scored_at="2001-11-01 00:00:00")
    out = IO.scratch_path(spark, "evaluation").replace(".parquet", "")
    base = baseline_scored(spark, sf_dir).agg(M.metric_exprs(Y, SEASONAL)["wape"]).first()[0]
    run_continuous_evaluation(preds, snaps, out, baseline_wape=base)
    return out


@register("evaluation_reports", W(_CUBE_SQL, SPLIT))
def q_evaluation_reports(spark, sf_dir):
    """The overall, by-facility and by-day reports read back with their declared schemas."""
    out = _evaluation_job(spark, sf_dir)
    cols = "n bigint, " + ", ".join(f"{m} double" for m in M.METRIC_NAMES)
    read = lambda name, keys: spark.read.schema(keys + cols).option("header", True).csv(f"{out}/{name}.csv")
    total = spark.read.schema(cols).json(f"{out}/evaluation_overall.json").withColumn("level", F.lit("overall"))
    fac = read("evaluation_by_facility", "facility_id string, ").withColumn("level", F.lit("facility"))
    day = read("evaluation_by_snapshot_day", "snapshot_day int, ").withColumn("level", F.lit("snapshot_day"))
    return M.reported(total.unionByName(fac, True).unionByName(day, True)).select("level", "facility_id", "snapshot_day", "n", *M.METRIC_NAMES)


@register("evaluation_scorecard", W(_K1 + f"""
UNION ALL
SELECT 'Beat manual analyst baseline', CAST(NULL AS BIGINT), 'wape', round(cw, 4), round(bw, 4),
       COALESCE(cw < bw, false), round(bw - cw, 4)
FROM (SELECT {O.wape_sql()} AS cw, {O.wape_sql(p='pred_seasonal')} AS bw FROM scored)""", _KPI_CTE.replace("WHERE split = 'test'", "")))
def q_evaluation_scorecard(spark, sf_dir):
    """K4 + A7: the scorecard report read back; verdicts come from unrounded metrics."""
    schema = "checkpoint string, snapshot_day bigint, metric string, value double, target double, met boolean, margin double"
    return spark.read.schema(schema).option("header", True).csv(f"{_evaluation_job(spark, sf_dir)}/kpi_scorecard.csv")


@register("lake_roundtrip", W(O.SNAPSHOT_SELECT))
def q_lake_roundtrip(spark, sf_dir):
    """A3/A4: write to the lake path (local fallback root here) and read back."""
    root = IO.scratch_path(spark, "lake_root").replace(".parquet", "")
    uri = IO.write_lake(snapshots(spark, sf_dir), "curated/revenue_snapshots.parquet", local_root=root)
    assert uri
    return IO.read_lake(spark, "curated/revenue_snapshots.parquet", local_root=root).select(*ALL_COLUMNS)


@register("default_datasets", W("""
SELECT 'full' AS dataset, COUNT(*) AS n_rows FROM snapshots
UNION ALL SELECT 'sample', LEAST(COUNT(*), 200) FROM snapshots
UNION ALL SELECT 'invalid', LEAST(COUNT(*), 20) FROM snapshots"""))
def q_default_datasets(spark, sf_dir):
    """Full Parquet, first-200 CSV sample and planted-fault CSV; row counts read back."""
    root = IO.scratch_path(spark, "datasets").replace(".parquet", "")
    paths = IO.materialise_default_datasets(snapshots(spark, sf_dir), root)
    full = IO.read_snapshots(spark, paths["full"]).agg(F.count(F.lit(1)).alias("n_rows"))
    sample = IO.read_snapshots(spark, paths["sample"]).agg(F.count(F.lit(1)).alias("n_rows"))
    invalid = IO.read_snapshots(spark, paths["invalid"]).agg(F.count(F.lit(1)).alias("n_rows"))
    return (full.select(F.lit("full").alias("dataset"), "n_rows")
            .unionByName(sample.select(F.lit("sample").alias("dataset"), "n_rows"))
            .unionByName(invalid.select(F.lit("invalid").alias("dataset"), "n_rows")))


# rows-only queries (ML training, explanation, streaming) live in their own module
from closecast.plans import registry_ml  # noqa: E402,F401
