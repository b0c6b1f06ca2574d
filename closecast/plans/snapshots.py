"""As-of month-to-date snapshots rebuilt from transaction facts.

Facility = supplier nation, month = ship month, money = line gross price.
The plan (one big shuffle, everything after it is small):

1. ``lineitem`` (7 columns, pruned at the scan) joined to ``supplier``'s
   ``(suppkey, nationkey)`` projection (broadcast only below a checked size),
   aggregated to one row per ``(nation, month, day-of-month)``. Partial
   aggregation runs before the shuffle, so even a facility holding a third of
   all rows sends at most one row per day per task.
2. That daily table is tiny (facilities x months x 31) and is checkpointed to
   the shared checkpoint dir, cutting the lineage to the fact scan.
3. Month-to-date sums: each daily row is exploded into the configured snapshot
   days it contributes to (``dom <= day``), then summed per day.
4. A gap-free facility x month grid carries the history windows (strictly
   prior months only), the day list is exploded per grid month, calendar
   columns are computed, and the nation / region dimensions are joined.

All money is summed as DECIMAL (exact, order-free) and cast to DOUBLE at the
snapshot edge, so results do not depend on partitioning.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closecast.functions import calendar as cal
from closecast.operators.joins import bounded_broadcast
from closecast.schema import (
    ALL_COLUMNS,
    SNAPSHOT_DAYS,
    TARGET,
    snapshot_schema,
)
from closecast.session import ensure_checkpoint_dir
from closecast.sources.tables import read_table

# Fixed mapping thresholds of the fact adapter.
INPATIENT_MIN_QUANTITY = 25
PAYMENT_LAG_DAYS = 6

_DAILY_SUMS = [
    "encounters", "discharges", "inpatient_volume", "outpatient_volume",
    "gross", "gross_inpatient", "gross_outpatient", "net", "denials",
    "adjustments", "bad_debt", "charity",
]


FACT_COLUMNS = ["l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity",
                "l_returnflag", "l_linestatus", "l_shipdate"]


def daily_facts(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Step 1: facts -> one row per (nation, month, day-of-month)."""
    li = lineitem.select(*FACT_COLUMNS).where(F.col("l_shipdate").isNotNull())
    sup = supplier.select("s_suppkey", "s_nationkey")
    facts = li.join(bounded_broadcast(sup), li.l_suppkey == sup.s_suppkey, "inner")

    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    inpatient = F.col("l_quantity") >= INPATIENT_MIN_QUANTITY
    zero = F.lit(0).cast("decimal(12,2)")

    return (
        facts.select(
            F.col("s_nationkey").alias("nk"),
            F.trunc(F.col("l_shipdate"), "month").alias("month_start"),
            F.dayofmonth("l_shipdate").alias("dom"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            gross.alias("g"), disc.alias("d"), tax.alias("t"),
            inpatient.alias("inp"), F.col("l_returnflag").alias("rf"),
            F.col("l_linestatus").alias("ls"),
        )
        .groupBy("nk", "month_start", "dom")
        .agg(
            F.count(F.lit(1)).alias("encounters"),
            F.count_if(F.col("ls") == "F").alias("discharges"),
            F.count_if(F.col("inp")).alias("inpatient_volume"),
            F.count_if(~F.col("inp")).alias("outpatient_volume"),
            F.sum("g").alias("gross"),
            F.sum(F.when(F.col("inp"), F.col("g")).otherwise(zero)).alias("gross_inpatient"),
            F.sum(F.when(~F.col("inp"), F.col("g")).otherwise(zero)).alias("gross_outpatient"),
            F.sum(F.col("g") * (F.lit(1) - F.col("d"))).alias("net"),
            F.sum(F.when(F.col("rf") == "R", F.col("g")).otherwise(zero)).alias("denials"),
            F.sum(F.col("g") * F.col("d")).alias("adjustments"),
            F.sum(F.when(F.col("rf") == "A", F.col("g")).otherwise(zero)).alias("bad_debt"),
            F.sum(F.col("g") * F.col("t")).alias("charity"),
            F.max("ship_date").alias("last_ship"),
        )
    )


def closed_month_bounds(daily: DataFrame) -> tuple | None:
    """(first month, last closed month) from the data; None when empty.

    A month is closed when a later month has rows or the newest ship date is
    the last calendar day of its month.
    """
    row = daily.agg(F.min("month_start").alias("first"), F.max("last_ship").alias("last")).first()
    if row is None or row["first"] is None:
        return None
    last = row["last"]
    last_month = last.replace(day=1)
    nxt = (last_month.replace(year=last_month.year + 1, month=1) if last_month.month == 12
           else last_month.replace(month=last_month.month + 1))
    import datetime as _dt
    closed_last = last_month if (nxt - _dt.timedelta(days=1)) == last else (
        (last_month - _dt.timedelta(days=1)).replace(day=1))
    return row["first"], closed_last


def build_snapshots(spark: SparkSession, sf_dir: str, days: list[int] | None = None) -> DataFrame:
    """Full 46-column snapshot table from the source tables under ``sf_dir``."""
    return build_snapshots_from(
        read_table(spark, sf_dir, "lineitem", FACT_COLUMNS),
        read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]),
        read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"]),
        read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]),
        days,
    )


def build_snapshots_from(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame,
                         days: list[int] | None = None) -> DataFrame:
    """Full 46-column snapshot table (training mode: target included)."""
    spark = lineitem.sparkSession
    days = sorted(set(days or SNAPSHOT_DAYS))
    if not days or min(days) < 1 or max(days) > 28:
        raise ValueError("snapshot days must be unique values in 1..28")
    ensure_checkpoint_dir(spark)
    daily = daily_facts(lineitem, supplier).checkpoint(eager=True)
    bounds = closed_month_bounds(daily)
    if bounds is None:
        return spark.createDataFrame([], snapshot_schema())
    first_month, last_closed = bounds
    daily = daily.where(F.col("month_start") <= F.lit(last_closed))

    # -- month grain: gap-free grid + strictly-prior history windows ----------
    monthly = daily.groupBy("nk", "month_start").agg(
        F.sum("net").alias("net"), F.sum("gross").alias("gross_m"),
        F.sum("denials").alias("denials_m"), F.sum("adjustments").alias("adj_m"),
    )
    grid = (
        daily.select("nk").distinct()
        .withColumn("month_start", F.explode(F.sequence(
            F.lit(first_month), F.lit(last_closed), F.expr("INTERVAL 1 MONTH"))))
    )
    zero4 = F.lit(0).cast("decimal(12,4)")
    m = grid.join(monthly, ["nk", "month_start"], "left").select(
        "nk", "month_start",
        *[F.coalesce(F.col(c), zero4).alias(c) for c in ["net", "gross_m", "denials_m", "adj_m"]],
    )
    w = Window.partitionBy("nk").orderBy("month_start")

    def trailing_mean(k: int):
        frame = w.rowsBetween(-k, -1)
        return F.sum("net").over(frame).cast("double") / F.count("net").over(frame)

    before = w.rowsBetween(Window.unboundedPreceding, -1)
    cum_gross = F.sum("gross_m").over(before).cast("double")
    hist = m.select(
        "nk", "month_start",
        F.round(F.col("net"), 2).cast("double").alias(TARGET),
        F.lag("net", 1).over(w).cast("double").alias("prior_month_net_revenue"),
        F.lag("net", 12).over(w).cast("double").alias("prior_year_same_month_net_revenue"),
        trailing_mean(3).alias("rolling_3_month_net_revenue"),
        trailing_mean(6).alias("rolling_6_month_net_revenue"),
        trailing_mean(12).alias("rolling_12_month_net_revenue"),
        F.try_divide(F.sum("net").over(before).cast("double"), cum_gross).alias("historical_collection_rate"),
        F.try_divide(F.sum("denials_m").over(before).cast("double"), cum_gross).alias("historical_denial_rate"),
        F.try_divide(F.sum("adj_m").over(before).cast("double"), cum_gross).alias("historical_adjustment_rate"),
    )

    # -- month-to-date sums per snapshot day ----------------------------------
    day_arr = F.array(*[F.lit(d) for d in days])
    mtd = (
        daily.withColumn("snapshot_day", F.explode(F.filter(day_arr, lambda d: d >= F.col("dom"))))
        .groupBy("nk", "month_start", "snapshot_day")
        .agg(
            *[F.sum(c).alias(c) for c in _DAILY_SUMS if c != "net"],
            F.sum(F.when(F.col("dom") <= F.col("snapshot_day") - PAYMENT_LAG_DAYS, F.col("net"))).alias("payments"),
        )
    )

    # -- snapshot grain --------------------------------------------------------
    snap = (
        hist.withColumn("snapshot_day", F.explode(day_arr))
        .join(mtd, ["nk", "month_start", "snapshot_day"], "left")
    )
    dims = _dimensions(nation, region)
    snap = snap.join(dims, "nk", "left")

    def measure(c: str):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    day = F.col("snapshot_day")
    month_num = F.month("month_start")
    null = F.lit(None).cast("double")
    out = snap.select(
        F.format_string("FAC-%03d", F.col("nk") + 1).alias("facility_id"),
        cal.month_label(F.col("month_start")).alias("accounting_month"),
        cal.date_label(F.make_date(F.year("month_start"), month_num, day)).alias("snapshot_date"),
        day.cast("bigint").alias("snapshot_day"),
        "service_line_group", "generic_payer_group", "encounter_class_group",
        measure("encounters").alias("month_to_date_encounters"),
        measure("discharges").alias("month_to_date_discharges"),
        (measure("encounters") / day.cast("double")).alias("month_to_date_average_daily_census"),
        null.alias("month_to_date_occupancy_rate"),
        null.alias("month_to_date_case_mix_index"),
        null.alias("month_to_date_length_of_stay"),
        null.alias("month_to_date_observation_rate"),
        null.alias("month_to_date_surgeries_inpatient"),
        null.alias("month_to_date_surgeries_outpatient"),
        null.alias("month_to_date_cath_lab_procedures"),
        null.alias("month_to_date_imaging_procedures"),
        measure("inpatient_volume").alias("month_to_date_inpatient_volume"),
        measure("outpatient_volume").alias("month_to_date_outpatient_volume"),
        measure("gross").alias("month_to_date_gross_charges"),
        measure("gross_inpatient").alias("month_to_date_gross_charges_inpatient"),
        measure("gross_outpatient").alias("month_to_date_gross_charges_outpatient"),
        measure("payments").alias("month_to_date_payments"),
        measure("denials").alias("month_to_date_denials"),
        measure("adjustments").alias("month_to_date_contractual_adjustments"),
        measure("bad_debt").alias("month_to_date_bad_debt"),
        measure("charity").alias("month_to_date_charity_care"),
        day.cast("double").alias("days_elapsed"),
        cal.business_days_through(F.col("month_start"), day).alias("business_days_elapsed"),
        (cal.days_in_month(F.col("month_start")) - day).cast("double").alias("remaining_days"),
        "prior_month_net_revenue", "prior_year_same_month_net_revenue",
        "rolling_3_month_net_revenue", "rolling_6_month_net_revenue", "rolling_12_month_net_revenue",
        "historical_collection_rate", "historical_denial_rate", "historical_adjustment_rate",
        null.alias("historical_payer_mix"), null.alias("historical_charge_lag_rate"),
        month_num.cast("bigint").alias("month"),
        (F.floor((month_num - 1) / 3) + 1).cast("bigint").alias("quarter"),
        cal.seasonal_sin(month_num).alias("month_sin"),
        cal.seasonal_cos(month_num).alias("month_cos"),
        TARGET,
    )
    return out.select(*ALL_COLUMNS)


def _dimensions(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nation -> the three dimension columns (region name, payer, class)."""
    nation = nation.select("n_nationkey", "n_regionkey")
    region = region.select("r_regionkey", "r_name")
    return nation.join(bounded_broadcast(region), nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("nk"),
        F.col("r_name").alias("service_line_group"),
        F.concat(F.lit("payer_"), (F.col("n_nationkey") % 4).cast("string")).alias("generic_payer_group"),
        F.concat(F.lit("class_"), (F.col("n_nationkey") % 3).cast("string")).alias("encounter_class_group"),
    )


# -- materialised snapshot table, shared by downstream operators -------------
_LOCK = threading.Lock()
_MEMO: dict[tuple, DataFrame] = {}


def input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """What the fact tables are just now: session, and each file's name, size and time. Rewritten input gets a new key."""
    files = []
    for name in ("lineitem", "supplier", "nation", "region"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for st in fs.listStatus(path):
            files.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return (spark.sparkContext.applicationId, tuple(sorted(files)))


def snapshot_table(spark: SparkSession, sf_dir: str, days: list[int] | None = None) -> DataFrame:
    """The snapshot table written once per session to the checkpoint dir.

    Downstream jobs (contracts, metrics, features, scoring, drift) read this
    Parquet table, partitioned by ``accounting_month`` so month filters prune
    files, instead of re-running the fact aggregation.
    """
    key = (*input_key(spark, sf_dir), tuple(sorted(set(days or SNAPSHOT_DAYS))))
    with _LOCK:
        cached = _MEMO.get(key)
        if cached is not None:
            return cached
        from closecast.sources.snapshot_io import read_snapshots, scratch_path, write_snapshots

        path = scratch_path(spark, "snapshots")
        write_snapshots(build_snapshots(spark, sf_dir, list(key[-1])), path)
        df = read_snapshots(spark, path)
        _MEMO[key] = df
        return df
