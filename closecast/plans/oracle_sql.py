"""Independent ANSI/DuckDB SQL statements used as the correctness oracle.

Each statement runs on the driver's pre-registered views (``lineitem``,
``supplier``, ``nation``, ``region``, ``documents`` ...). The snapshot table is
rebuilt as a CTE so every statement reads the whole source tables.
"""

from __future__ import annotations

from closecast.schema import ALL_COLUMNS, SNAPSHOT_DAYS


def _days_values(days=None) -> str:
    return ", ".join(f"({d})" for d in sorted(set(days or SNAPSHOT_DAYS)))


def snapshot_ctes(days=None) -> str:
    """CTEs ending in ``snapshots`` (46 columns, one row per facility-month-day)."""
    return f"""
facts AS (
  SELECT s.s_nationkey AS nk,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month_start,
         CAST(day(l.l_shipdate) AS INTEGER) AS dom,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS g,
         CAST(l.l_discount AS DECIMAL(4,2)) AS d,
         CAST(l.l_tax AS DECIMAL(4,2)) AS t,
         l.l_quantity >= 25 AS inp,
         l.l_returnflag AS rf, l.l_linestatus AS ls
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_shipdate IS NOT NULL
),
bounds AS (
  SELECT min(month_start) AS first_month,
         CASE WHEN max(ship_date) = last_day(max(ship_date))
              THEN CAST(date_trunc('month', max(ship_date)) AS DATE)
              ELSE CAST(date_trunc('month', max(ship_date)) - INTERVAL 1 MONTH AS DATE) END AS last_closed
  FROM facts
),
cfacts AS (SELECT f.* FROM facts f, bounds b WHERE f.month_start <= b.last_closed),
days AS (SELECT * FROM (VALUES {_days_values(days)}) v(snapshot_day)),
monthly AS (
  SELECT nk, month_start, SUM(g * (1 - d)) AS net, SUM(g) AS gross_m,
         SUM(CASE WHEN rf = 'R' THEN g ELSE 0 END) AS denials_m, SUM(g * d) AS adj_m
  FROM cfacts GROUP BY nk, month_start
),
grid AS (
  SELECT f.nk, CAST(m.month_start AS DATE) AS month_start
  FROM (SELECT DISTINCT nk FROM cfacts) f
  CROSS JOIN (SELECT unnest(generate_series(CAST(first_month AS TIMESTAMP), CAST(last_closed AS TIMESTAMP), INTERVAL 1 MONTH)) AS month_start FROM bounds) m
),
gm AS (
  SELECT g.nk, g.month_start, COALESCE(x.net, 0) AS net, COALESCE(x.gross_m, 0) AS gross_m,
         COALESCE(x.denials_m, 0) AS denials_m, COALESCE(x.adj_m, 0) AS adj_m
  FROM grid g LEFT JOIN monthly x ON g.nk = x.nk AND g.month_start = x.month_start
),
hist AS (
  SELECT nk, month_start,
    CAST(round(net, 2) AS DOUBLE) AS actual_month_end_net_revenue,
    CAST(lag(net, 1) OVER w AS DOUBLE) AS prior_month_net_revenue,
    CAST(lag(net, 12) OVER w AS DOUBLE) AS prior_year_same_month_net_revenue,
    CAST(SUM(net) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(COUNT(net) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS rolling_3_month_net_revenue,
    CAST(SUM(net) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(COUNT(net) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0) AS rolling_6_month_net_revenue,
    CAST(SUM(net) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(COUNT(net) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 0) AS rolling_12_month_net_revenue,
    CAST(SUM(net) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(CAST(SUM(gross_m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0) AS historical_collection_rate,
    CAST(SUM(denials_m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(CAST(SUM(gross_m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0) AS historical_denial_rate,
    CAST(SUM(adj_m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / NULLIF(CAST(SUM(gross_m) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0) AS historical_adjustment_rate
  FROM gm
  WINDOW w AS (PARTITION BY nk ORDER BY month_start)
),
mtd AS (
  SELECT f.nk, f.month_start, dd.snapshot_day,
    COUNT(*) AS encounters,
    COUNT(*) FILTER (WHERE ls = 'F') AS discharges,
    COUNT(*) FILTER (WHERE inp) AS inpatient_volume,
    COUNT(*) FILTER (WHERE NOT inp) AS outpatient_volume,
    SUM(g) AS gross,
    SUM(CASE WHEN inp THEN g ELSE 0 END) AS gross_inpatient,
    SUM(CASE WHEN NOT inp THEN g ELSE 0 END) AS gross_outpatient,
    SUM(CASE WHEN f.dom <= dd.snapshot_day - 6 THEN g * (1 - d) END) AS payments,
    SUM(CASE WHEN rf = 'R' THEN g ELSE 0 END) AS denials,
    SUM(g * d) AS adjustments,
    SUM(CASE WHEN rf = 'A' THEN g ELSE 0 END) AS bad_debt,
    SUM(g * t) AS charity
  FROM cfacts f JOIN days dd ON f.dom <= dd.snapshot_day
  GROUP BY f.nk, f.month_start, dd.snapshot_day
),
dims AS (
  SELECT n.n_nationkey AS nk, r.r_name AS service_line_group,
         'payer_' || CAST(n.n_nationkey % 4 AS VARCHAR) AS generic_payer_group,
         'class_' || CAST(n.n_nationkey % 3 AS VARCHAR) AS encounter_class_group
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
snap_raw AS (
  SELECT h.*, dd.snapshot_day, m.encounters, m.discharges, m.inpatient_volume, m.outpatient_volume,
         m.gross, m.gross_inpatient, m.gross_outpatient, m.payments, m.denials, m.adjustments,
         m.bad_debt, m.charity, dm.service_line_group, dm.generic_payer_group, dm.encounter_class_group,
         CAST(month(h.month_start) AS BIGINT) AS mo, isodow(h.month_start) - 1 AS w0
  FROM hist h CROSS JOIN days dd
  LEFT JOIN mtd m ON m.nk = h.nk AND m.month_start = h.month_start AND m.snapshot_day = dd.snapshot_day
  LEFT JOIN dims dm ON dm.nk = h.nk
),
snapshots AS (
  SELECT
    printf('FAC-%03d', nk + 1) AS facility_id,
    strftime(month_start, '%Y-%m') AS accounting_month,
    strftime(make_date(year(month_start), month(month_start), snapshot_day), '%Y-%m-%d') AS snapshot_date,
    CAST(snapshot_day AS BIGINT) AS snapshot_day,
    service_line_group, generic_payer_group, encounter_class_group,
    COALESCE(CAST(encounters AS DOUBLE), 0.0) AS month_to_date_encounters,
    COALESCE(CAST(discharges AS DOUBLE), 0.0) AS month_to_date_discharges,
    COALESCE(CAST(encounters AS DOUBLE), 0.0) / CAST(snapshot_day AS DOUBLE) AS month_to_date_average_daily_census,
    CAST(NULL AS DOUBLE) AS month_to_date_occupancy_rate,
    CAST(NULL AS DOUBLE) AS month_to_date_case_mix_index,
    CAST(NULL AS DOUBLE) AS month_to_date_length_of_stay,
    CAST(NULL AS DOUBLE) AS month_to_date_observation_rate,
    CAST(NULL AS DOUBLE) AS month_to_date_surgeries_inpatient,
    CAST(NULL AS DOUBLE) AS month_to_date_surgeries_outpatient,
    CAST(NULL AS DOUBLE) AS month_to_date_cath_lab_procedures,
    CAST(NULL AS DOUBLE) AS month_to_date_imaging_procedures,
    COALESCE(CAST(inpatient_volume AS DOUBLE), 0.0) AS month_to_date_inpatient_volume,
    COALESCE(CAST(outpatient_volume AS DOUBLE), 0.0) AS month_to_date_outpatient_volume,
    COALESCE(CAST(gross AS DOUBLE), 0.0) AS month_to_date_gross_charges,
    COALESCE(CAST(gross_inpatient AS DOUBLE), 0.0) AS month_to_date_gross_charges_inpatient,
    COALESCE(CAST(gross_outpatient AS DOUBLE), 0.0) AS month_to_date_gross_charges_outpatient,
    COALESCE(CAST(payments AS DOUBLE), 0.0) AS month_to_date_payments,
    COALESCE(CAST(denials AS DOUBLE), 0.0) AS month_to_date_denials,
    COALESCE(CAST(adjustments AS DOUBLE), 0.0) AS month_to_date_contractual_adjustments,
    COALESCE(CAST(bad_debt AS DOUBLE), 0.0) AS month_to_date_bad_debt,
    COALESCE(CAST(charity AS DOUBLE), 0.0) AS month_to_date_charity_care,
    CAST(snapshot_day AS DOUBLE) AS days_elapsed,
    CAST((snapshot_day // 7) * 5 + snapshot_day % 7
         - (CASE WHEN (12 - w0) % 7 < snapshot_day % 7 THEN 1 ELSE 0 END)
         - (CASE WHEN (13 - w0) % 7 < snapshot_day % 7 THEN 1 ELSE 0 END) AS DOUBLE) AS business_days_elapsed,
    CAST(day(last_day(month_start)) - snapshot_day AS DOUBLE) AS remaining_days,
    prior_month_net_revenue, prior_year_same_month_net_revenue,
    rolling_3_month_net_revenue, rolling_6_month_net_revenue, rolling_12_month_net_revenue,
    historical_collection_rate, historical_denial_rate, historical_adjustment_rate,
    CAST(NULL AS DOUBLE) AS historical_payer_mix, CAST(NULL AS DOUBLE) AS historical_charge_lag_rate,
    mo AS month,
    CAST((mo - 1) // 3 + 1 AS BIGINT) AS quarter,
    CASE WHEN round(sin(2 * pi() * (mo - 1) / 12), 6) = 0 THEN 0.0 ELSE round(sin(2 * pi() * (mo - 1) / 12), 6) END AS month_sin,
    CASE WHEN round(cos(2 * pi() * (mo - 1) / 12), 6) = 0 THEN 0.0 ELSE round(cos(2 * pi() * (mo - 1) / 12), 6) END AS month_cos,
    actual_month_end_net_revenue
  FROM snap_raw
)"""


def with_snapshots(body: str, extra_ctes: str = "", days=None) -> str:
    """``WITH <snapshot ctes>[, extra] <body>``."""
    extra = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH {snapshot_ctes(days)}{extra}\n{body}"


SNAPSHOT_SELECT = "SELECT " + ", ".join(ALL_COLUMNS) + " FROM snapshots"


# -- shared oracle fragments ---------------------------------------------------
SPLIT_CTES = """
month_rank AS (
  SELECT accounting_month, dense_rank() OVER (ORDER BY accounting_month DESC) AS rdesc
  FROM (SELECT DISTINCT accounting_month FROM snapshots)
),
split AS (
  SELECT s.*, CASE WHEN r.rdesc <= 4 THEN 'test' WHEN r.rdesc <= 8 THEN 'validation' ELSE 'train' END AS split
  FROM snapshots s JOIN month_rank r ON s.accounting_month = r.accounting_month
),
fb AS (
  SELECT COALESCE(CAST(SUM(CAST(actual_month_end_net_revenue AS DECIMAL(38,4))) AS DOUBLE)
                  / CAST(COUNT(actual_month_end_net_revenue) AS DOUBLE), 0.0) AS fallback
  FROM split WHERE split = 'train' AND isfinite(actual_month_end_net_revenue)
),
scored AS (
  SELECT sp.*,
    COALESCE(CASE WHEN isfinite(prior_month_net_revenue) THEN prior_month_net_revenue END, fb.fallback)
      AS predicted_month_end_net_revenue,
    COALESCE(CASE WHEN isfinite(prior_year_same_month_net_revenue) THEN prior_year_same_month_net_revenue END, fb.fallback)
      AS pred_seasonal
  FROM split sp, fb
)"""


def metric_sql(y: str = "actual_month_end_net_revenue", p: str = "predicted_month_end_net_revenue",
               rounded: bool = True) -> str:
    """SELECT-list of n + the seven metrics (report precision when rounded)."""
    def r(expr, places):
        if not rounded:
            return expr
        return f"CAST(CAST({expr} AS REAL) AS DOUBLE)" if places is None else f"round({expr}, {places})"

    e = f"({y} - {p})"
    return ",\n".join([
        "COUNT(*) AS n",
        r(f"CASE WHEN SUM(abs({y})) < 1e-9 THEN NULL ELSE SUM(abs({e})) / SUM(abs({y})) END", 6) + " AS wape",
        r(f"CASE WHEN abs(SUM({y})) < 1e-9 THEN NULL ELSE SUM({p} - {y}) / SUM({y}) END", 6) + " AS bias",
        r(f"AVG(abs({e}))", 3) + " AS mae",
        r(f"sqrt(AVG({e} * {e}))", 3) + " AS rmse",
        r(f"AVG(abs({e}) / CASE WHEN abs({y}) < 1e-9 THEN 1e-9 ELSE abs({y}) END)", None) + " AS mape",
        r(f"AVG(2.0 * abs({p} - {y}) / CASE WHEN abs({y}) + abs({p}) = 0 THEN 1.0 ELSE abs({y}) + abs({p}) END)", 6)
        + " AS smape",
        r(f"CASE WHEN COUNT(*) <= 1 THEN NULL WHEN MIN({y}) = MAX({y}) THEN "
          f"(CASE WHEN SUM({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END) "
          f"ELSE 1.0 - SUM({e} * {e}) / (var_pop({y}) * COUNT(*)) END", 6) + " AS r2",
    ])


def wape_sql(y: str = "actual_month_end_net_revenue", p: str = "predicted_month_end_net_revenue") -> str:
    return f"CASE WHEN SUM(abs({y})) < 1e-9 THEN NULL ELSE SUM(abs({y} - {p})) / SUM(abs({y})) END"


def spark_percentile_sql(list_expr: str, q: str) -> str:
    """Linear-interpolated percentile of a sorted DuckDB list, using the
    weights (hi - pos) * lo + (pos - lo) * hi of Spark's exact ``percentile``."""
    n = f"len({list_expr})"
    pos = f"(({n} - 1) * {q})"
    lo = f"floor({pos})"
    hi = f"ceil({pos})"
    lo_v = f"{list_expr}[CAST({lo} AS BIGINT) + 1]"
    hi_v = f"{list_expr}[CAST({hi} AS BIGINT) + 1]"
    return (f"(CASE WHEN {n} = 0 THEN NULL WHEN {lo} = {hi} OR {lo_v} = {hi_v} THEN {lo_v} "
            f"ELSE ({hi} - {pos}) * {lo_v} + ({pos} - {lo}) * {hi_v} END)")

# Non-DOUBLE snapshot columns (``isnan`` only applies to the others).
NON_DOUBLE = {"facility_id", "accounting_month", "snapshot_date", "snapshot_day", "service_line_group",
              "generic_payer_group", "encounter_class_group", "month", "quarter"}
