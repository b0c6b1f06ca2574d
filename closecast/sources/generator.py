"""Seeded synthetic facility-month snapshots (unit fixtures only).

Not a registered query: registered jobs read the driver's tables (G11). The
generator is still a Spark job: ``spark.range`` over facilities, months and
days, with every random draw a pure function of (seed, key, name) via
``xxhash64``. The output therefore does not depend on partitioning (``rand()``
would). Normals use Box-Muller on two keyed uniforms.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closecast.functions import calendar as cal
from closecast.schema import ALL_COLUMNS, SNAPSHOT_DAYS

# fixed values: dimension members (cycled by facility index)
SERVICE_LINES = ["acute_inpatient", "ambulatory_surgery", "emergency", "outpatient_clinic"]
PAYER_GROUPS = ["commercial", "managed_government", "government", "self_pay"]
ENCOUNTER_CLASSES = ["inpatient", "outpatient", "emergency", "observation"]
# fixed values: profile ranges (uniform low, high)
PROFILE_RANGES = {
    "base": (1.2e6, 6.5e6), "trend": (-0.004, 0.010), "amp": (0.04, 0.12),
    "collection": (0.30, 0.52), "denial": (0.04, 0.12), "adjustment": (0.35, 0.55),
    "payer_mix": (0.35, 0.70), "inpatient_share": (0.25, 0.65), "case_mix": (1.1, 1.9),
    "beds": (80, 420), "occupancy": (0.58, 0.86), "observation": (0.08, 0.18), "lag": (0.05, 0.20),
}
MASKABLE = ["month_to_date_denials", "month_to_date_contractual_adjustments", "month_to_date_bad_debt",
            "month_to_date_charity_care", "month_to_date_case_mix_index"]


@dataclass
class GeneratorConfig:
    seed: int = 42
    n_facilities: int = 6
    n_months: int = 30
    start_year: int = 2023
    start_month: int = 1
    snapshot_days: list[int] = field(default_factory=lambda: list(SNAPSHOT_DAYS))
    missing_rate: float = 0.03
    outlier_rate: float = 0.01
    noise_scale: float = 0.04
    num_partitions: int | None = None  # facility-range partitions (output must not depend on it)


def _u(seed: int, name: str, *keys: Column) -> Column:
    """Keyed uniform in [0, 1)."""
    h = F.xxhash64(F.lit(seed), F.lit(name), *keys)
    return (F.pmod(h, F.lit(1 << 52)).cast("double")) / float(1 << 52)


def _normal(seed: int, name: str, mean: float, sd: float, *keys: Column) -> Column:
    u1 = F.greatest(_u(seed, name + ":a", *keys), F.lit(1e-12))
    u2 = _u(seed, name + ":b", *keys)
    return F.lit(mean) + F.lit(sd) * F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)


def _uniform(seed: int, name: str, *keys: Column) -> Column:
    lo, hi = PROFILE_RANGES[name]
    return F.lit(lo) + (hi - lo) * _u(seed, name, *keys)


def facility_profiles(spark: SparkSession, cfg: GeneratorConfig) -> DataFrame:
    """G1: one row per facility."""
    i = F.col("id")
    s = cfg.seed
    base = _uniform(s, "base", i)
    return spark.range(0, cfg.n_facilities, numPartitions=cfg.num_partitions).select(
        i.alias("fi"), F.format_string("FAC-%03d", i + 1).alias("facility_id"),
        base.alias("base"), (_uniform(s, "trend", i) * base).alias("trend"),
        *[_uniform(s, k, i).alias(k) for k in ("amp", "collection", "denial", "adjustment", "payer_mix",
                                                "inpatient_share", "case_mix", "occupancy", "observation", "lag")],
        F.floor(_uniform(s, "beds", i)).cast("int").alias("beds"),
        F.element_at(F.array(*map(F.lit, SERVICE_LINES)), (i % 4 + 1).cast("int")).alias("service_line_group"),
        F.element_at(F.array(*map(F.lit, PAYER_GROUPS)), (i % 4 + 1).cast("int")).alias("generic_payer_group"),
        F.element_at(F.array(*map(F.lit, ENCOUNTER_CLASSES)), (i % 4 + 1).cast("int")).alias("encounter_class_group"),
    )


def generate_snapshots(spark: SparkSession, cfg: GeneratorConfig | None = None) -> DataFrame:
    """The full synthetic snapshot table (46 columns)."""
    cfg = cfg or GeneratorConfig()
    s = cfg.seed
    prof = facility_profiles(spark, cfg)
    # Month index; G3: monthly actuals
    start = F.make_date(F.lit(cfg.start_year), F.lit(cfg.start_month), F.lit(1))
    m = prof.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(cfg.n_months - 1))))
    m = m.withColumn("month_start", F.add_months(start, F.col("idx")))
    mo = F.month("month_start")
    seasonal = 1.0 + F.col("amp") * F.sin(2 * math.pi * (mo - 1) / 12.0)
    noise = _normal(s, "noise", 1.0, cfg.noise_scale, F.col("fi"), F.col("idx"))
    m = m.withColumn("actual", F.greatest(F.lit(5.0e4), (F.col("base") + F.col("trend") * F.col("idx")) * seasonal * noise))
    # History from strictly prior months (unrounded actuals)
    w = Window.partitionBy("fi").orderBy("idx")
    m = m.select("*",
                 F.lag("actual", 1).over(w).alias("prior_month_net_revenue"),
                 F.lag("actual", 12).over(w).alias("prior_year_same_month_net_revenue"),
                 *[F.avg("actual").over(w.rowsBetween(-k, -1)).alias(f"rolling_{k}_month_net_revenue") for k in (3, 6, 12)])
    # One row per configured day; G6 progress
    days = sorted(set(cfg.snapshot_days))
    snap = m.withColumn("snapshot_day", F.explode(F.array(*map(F.lit, days))))
    dim = cal.days_in_month(F.col("month_start"))
    snap = snap.where(F.col("snapshot_day") <= dim)
    key = (F.col("fi"), F.col("idx"), F.col("snapshot_day"))
    frac = F.col("snapshot_day") / dim
    gross_frac = F.least(F.lit(1.0), F.pow(frac, 0.92))
    gross = F.col("actual") / F.col("collection") * gross_frac
    pay_frac = F.pow(F.greatest(F.lit(0.0), frac - 0.18), 1.05)
    enc = F.col("base") / 4200.0 * gross_frac
    occ = F.least(F.greatest(F.col("occupancy") * _normal(s, "occ", 1.0, 0.03, *key), F.lit(0.2)), F.lit(0.99))
    obs = F.least(F.greatest(F.col("observation") * _normal(s, "obs", 1.0, 0.06, *key), F.lit(0.0)), F.lit(0.6))
    share = F.col("inpatient_share")
    nn = lambda c: F.greatest(F.lit(0.0), c)
    # Month-to-date measures
    snap = snap.select(
        "*",
        F.round(enc, 2).alias("month_to_date_encounters"),
        F.round(enc * share * 0.35, 2).alias("month_to_date_discharges"),
        F.round(nn(F.col("beds") * occ), 2).alias("month_to_date_average_daily_census"),
        F.round(occ, 4).alias("month_to_date_occupancy_rate"),
        F.round(F.col("case_mix"), 4).alias("month_to_date_case_mix_index"),
        F.round(nn(_normal(s, "los", 4.2, 0.4, *key) * F.col("case_mix")), 3).alias("month_to_date_length_of_stay"),
        F.round(obs, 4).alias("month_to_date_observation_rate"),
        F.round(nn(enc * 0.12 * share), 2).alias("month_to_date_surgeries_inpatient"),
        F.round(nn(enc * 0.12 * (1 - share)), 2).alias("month_to_date_surgeries_outpatient"),
        F.round(nn(enc * 0.04 * _normal(s, "cath", 1.0, 0.05, *key)), 2).alias("month_to_date_cath_lab_procedures"),
        F.round(nn(enc * 0.55 * _normal(s, "img", 1.0, 0.05, *key)), 2).alias("month_to_date_imaging_procedures"),
        F.round(enc * share, 2).alias("month_to_date_inpatient_volume"),
        F.round(enc * (1 - share), 2).alias("month_to_date_outpatient_volume"),
        F.round(gross, 2).alias("month_to_date_gross_charges"),
        F.round(nn(gross * share), 2).alias("month_to_date_gross_charges_inpatient"),
        F.round(nn(gross * (1 - share)), 2).alias("month_to_date_gross_charges_outpatient"),
        F.round(nn(F.col("actual") * F.least(F.lit(1.0), pay_frac) * _normal(s, "pay", 1.0, 0.03, *key)), 2)
        .alias("month_to_date_payments"),
        F.round(nn(gross * F.col("denial") * _normal(s, "den", 1.0, 0.05, *key)), 2).alias("month_to_date_denials"),
        F.round(nn(gross * F.col("adjustment") * _normal(s, "adj", 1.0, 0.04, *key)), 2)
        .alias("month_to_date_contractual_adjustments"),
        F.round(nn(gross * 0.02 * _normal(s, "bad", 1.0, 0.1, *key)), 2).alias("month_to_date_bad_debt"),
        F.round(nn(gross * 0.015 * _normal(s, "char", 1.0, 0.1, *key)), 2).alias("month_to_date_charity_care"),
        F.col("snapshot_day").cast("double").alias("days_elapsed"),
        cal.business_days_through(F.col("month_start"), F.col("snapshot_day")).alias("business_days_elapsed"),
        (dim - F.col("snapshot_day")).cast("double").alias("remaining_days"),
        F.round("collection", 4).alias("historical_collection_rate"),
        F.round("denial", 4).alias("historical_denial_rate"),
        F.round("adjustment", 4).alias("historical_adjustment_rate"),
        F.round("payer_mix", 4).alias("historical_payer_mix"),
        F.round("lag", 4).alias("historical_charge_lag_rate"),
        mo.cast("bigint").alias("month"), (F.floor((mo - 1) / 3) + 1).cast("bigint").alias("quarter"),
        cal.seasonal_sin(mo).alias("month_sin"), cal.seasonal_cos(mo).alias("month_cos"),
        F.round("actual", 2).alias("actual_month_end_net_revenue"),
        cal.month_label(F.col("month_start")).alias("accounting_month"),
        cal.date_label(F.make_date(F.year("month_start"), mo, F.col("snapshot_day"))).alias("snapshot_date"),
    )
    snap = snap.withColumn("snapshot_day", F.col("snapshot_day").cast("bigint"))
    # Missing cells; G10: gross-charge outliers (parts left as they are)
    if cfg.missing_rate > 0:
        snap = snap.withColumns({
            c: F.when(_u(s, "miss:" + c, *key) < cfg.missing_rate, F.lit(None).cast("double")).otherwise(F.col(c))
            for c in MASKABLE})
    if cfg.outlier_rate > 0:
        mult = F.lit(2.5) + 1.5 * _u(s, "outlier_mult", *key)
        snap = snap.withColumn("month_to_date_gross_charges", F.when(
            _u(s, "outlier", *key) < cfg.outlier_rate, F.col("month_to_date_gross_charges") * mult)
            .otherwise(F.col("month_to_date_gross_charges")))
    return snap.select(*ALL_COLUMNS)
