"""The facility x accounting-month x snapshot-date grain: columns, types, rules.

The names, patterns and thresholds below are fixed values of the data contract
that downstream users rely on; they must not drift.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: grain and column names -------------------------------------
FACILITY = "facility_id"
MONTH = "accounting_month"
SNAPSHOT_DATE = "snapshot_date"
SNAPSHOT_DAY = "snapshot_day"
KEYS = [FACILITY, MONTH, SNAPSHOT_DATE, SNAPSHOT_DAY]

DIMENSIONS = ["service_line_group", "generic_payer_group", "encounter_class_group"]

MTD_MEASURES = [
    "month_to_date_encounters",
    "month_to_date_discharges",
    "month_to_date_average_daily_census",
    "month_to_date_occupancy_rate",
    "month_to_date_case_mix_index",
    "month_to_date_length_of_stay",
    "month_to_date_observation_rate",
    "month_to_date_surgeries_inpatient",
    "month_to_date_surgeries_outpatient",
    "month_to_date_cath_lab_procedures",
    "month_to_date_imaging_procedures",
    "month_to_date_inpatient_volume",
    "month_to_date_outpatient_volume",
    "month_to_date_gross_charges",
    "month_to_date_gross_charges_inpatient",
    "month_to_date_gross_charges_outpatient",
    "month_to_date_payments",
    "month_to_date_denials",
    "month_to_date_contractual_adjustments",
    "month_to_date_bad_debt",
    "month_to_date_charity_care",
]
PROGRESS = ["days_elapsed", "business_days_elapsed", "remaining_days"]
OPERATIONAL = MTD_MEASURES + PROGRESS

HISTORICAL = [
    "prior_month_net_revenue",
    "prior_year_same_month_net_revenue",
    "rolling_3_month_net_revenue",
    "rolling_6_month_net_revenue",
    "rolling_12_month_net_revenue",
    "historical_collection_rate",
    "historical_denial_rate",
    "historical_adjustment_rate",
    "historical_payer_mix",
    "historical_charge_lag_rate",
    "month",
    "quarter",
    "month_sin",
    "month_cos",
]

TARGET = "actual_month_end_net_revenue"
PREDICTION = "predicted_month_end_net_revenue"

FEATURES = DIMENSIONS + OPERATIONAL + HISTORICAL
ALL_COLUMNS = KEYS + FEATURES + [TARGET]

DERIVED = [
    "mtd_collection_ratio",
    "mtd_denial_ratio",
    "mtd_adjustment_ratio",
    "mtd_gross_run_rate",
    "fraction_month_elapsed",
]

# Post-close columns that must never reach a feature builder.
FORBIDDEN_FUTURE = [
    TARGET,
    "final_contractual_adjustments",
    "final_denials",
    "month_end_close_flag",
]

# Contract patterns (shape only).
FACILITY_PATTERN = r"^FAC-\d{3}$"
MONTH_PATTERN = r"^\d{4}-\d{2}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# Default configuration.
SNAPSHOT_DAYS = [7, 10, 12, 15, 18, 21, 24, 27]
DEMO_CUTOFF_DAY = 15
N_TEST_MONTHS = 4
N_VAL_MONTHS = 4
N_BACKTEST_FOLDS = 3
CHALLENGER_THRESHOLD = 0.02
# --- end of fixed values ------------------------------------------------------

_INT_COLS = {SNAPSHOT_DAY, "month", "quarter"}
_STR_COLS = {FACILITY, MONTH, SNAPSHOT_DATE, *DIMENSIONS}


def _type_of(name: str) -> T.DataType:
    if name in _INT_COLS:
        return T.LongType()
    if name in _STR_COLS:
        return T.StringType()
    return T.DoubleType()


def snapshot_schema(with_target: bool = True) -> T.StructType:
    """The declared StructType of a raw snapshot table (drives every read)."""
    cols = ALL_COLUMNS if with_target else [c for c in ALL_COLUMNS if c != TARGET]
    return T.StructType([T.StructField(c, _type_of(c), True) for c in cols])


def numeric_feature_columns() -> list[str]:
    """Numeric model inputs in builder order: operational, historical, derived."""
    return OPERATIONAL + HISTORICAL + DERIVED
