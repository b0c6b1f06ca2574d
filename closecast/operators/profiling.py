"""M12-M18, G2/G4-G6 helpers, D6: dataset profiles and month-grain series.

Wide per-column statistics are computed in ONE aggregate and unpivoted
afterwards, instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closecast.functions import calendar as cal
from closecast.functions.columns import finite_or_null
from closecast.functions.quantiles import quantile
from closecast.operators.baselines import exact_mean
from closecast.operators.features import fit_statistics
from closecast.operators.metrics import METRIC_NAMES, metrics_overall
from closecast.schema import FACILITY, MONTH, OPERATIONAL, PREDICTION, SNAPSHOT_DATE, SNAPSHOT_DAY, TARGET


def _unpivot_row(wide: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names])).alias("s")).select("s.*")


def month_number(month):
    """Calendar months since year 0 of a ``yyyy-MM`` label."""
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")


def month_index(snaps: DataFrame) -> DataFrame:
    """Distinct months with the number of calendar months since the first (a gap keeps its place)."""
    months = snaps.select(MONTH).distinct()
    first = months.agg(F.min(month_number(F.col(MONTH))).alias("_first"))  # one row
    return months.crossJoin(F.broadcast(first)).select(
        MONTH, (month_number(F.col(MONTH)) - F.col("_first")).cast("bigint").alias("month_idx"),
        F.substring(MONTH, 1, 4).cast("bigint").alias("year"), F.substring(MONTH, 6, 2).cast("bigint").alias("month"))


def facility_month_series(snaps: DataFrame, y: str = TARGET, facility: str | None = None) -> DataFrame:
    """One target per facility-month (``min`` = ``first`` under the
    contract); all facilities, or one (P5) when ``facility`` is given."""
    if facility is not None:
        snaps = facility_rows(snaps, facility)
    return snaps.groupBy(FACILITY, MONTH).agg(F.min(y).alias("first_target"))


def facility_rows(snaps: DataFrame, facility: str) -> DataFrame:
    """P5: rows of one facility; unknown facility raises ``KeyError``.

    The existence probe is ``limit(1)``, so it stops at the first match."""
    rows = snaps.where(F.col(FACILITY) == facility)
    if rows.limit(1).count() == 0:
        raise KeyError(f"unknown facility {facility!r}")
    return rows


def month_history(series: DataFrame, value: str, partition: str = FACILITY, order: str = MONTH) -> DataFrame:
    """G4/W1/W2 on any month series: lag 1, lag 12 and trailing means over
    strictly prior calendar months (exact DECIMAL window sums, partial windows
    allowed). Frames are ranges of months, so a missing month shifts nothing."""
    w = Window.partitionBy(partition).orderBy("_m")
    series = series.withColumn("_m", month_number(F.col(order)))

    def trailing(k: int):
        frame = w.rangeBetween(-k, -1)
        return (F.sum(F.col(value).cast("decimal(20,2)")).over(frame).cast("double")
                / F.count(value).over(frame))

    return series.select(
        partition, order, value,
        F.max(value).over(w.rangeBetween(-1, -1)).alias("prior_month"), F.max(value).over(w.rangeBetween(-12, -12)).alias("prior_year_same_month"),
        trailing(3).alias("rolling_3"), trailing(6).alias("rolling_6"), trailing(12).alias("rolling_12"))


def calendar_features(snaps: DataFrame) -> DataFrame:
    """G5 from the month label."""
    m = F.substring(MONTH, 6, 2).cast("bigint")
    return snaps.select(MONTH).distinct().select(
        MONTH, m.alias("month"), (F.floor((m - 1) / 3) + 1).cast("bigint").alias("quarter"),
        cal.seasonal_sin(m).alias("month_sin"), cal.seasonal_cos(m).alias("month_cos"))


def period_progress(snaps: DataFrame) -> DataFrame:
    """G6 from the snapshot date."""
    d = F.to_date(SNAPSHOT_DATE)
    start = F.trunc(d, "month")
    day = F.dayofmonth(d)
    return snaps.select(SNAPSHOT_DATE).distinct().select(
        SNAPSHOT_DATE, day.cast("double").alias("days_elapsed"),
        cal.business_days_through(start, day).alias("business_days_elapsed"),
        (cal.days_in_month(start) - day).cast("double").alias("remaining_days"))


def dataset_overview(snaps: DataFrame) -> DataFrame:
    """Rows, facilities, months, days and the target range in one aggregate.

    Facility and day lists are bounded (distinct sets of small dimensions)."""
    return snaps.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(FACILITY).alias("n_facilities"),
        F.count_distinct(MONTH).alias("n_months"),
        F.array_join(F.array_sort(F.collect_set(FACILITY)), ",").alias("facilities"),
        F.array_join(F.array_sort(F.collect_set(SNAPSHOT_DAY)).cast("array<string>"), ",").alias("snapshot_days"),
        F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"),
        exact_mean(TARGET).alias("target_mean"), F.min(TARGET).alias("target_min"), F.max(TARGET).alias("target_max"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with any missing value: count, share (4 places)."""
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in df.columns:
        col = F.col(f"`{c}`")
        miss = col.isNull() | F.isnan(col) if dtypes[c] in ("double", "float") else col.isNull()
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(*aggs)
    long = wide.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing_count")) for c in df.columns])).alias("s"))
    return long.select("s.column", "s.missing_count",
                       F.round(F.col("s.missing_count") / F.col("__n"), 4).alias("missing_pct")).where(
        "missing_count > 0").orderBy(F.col("missing_count").desc(), "column")


def outlier_count(df: DataFrame, col: str = "month_to_date_gross_charges", q: float = 0.99,
                  factor: float = 1.5) -> DataFrame:
    """Rows above ``factor`` x the q-quantile. The quantile is one scalar
    (first job); the count is a filtered aggregate on it (second job)."""
    p = quantile(df, F.col(col), q)
    thr = F.lit(p).cast("double")
    return df.agg(F.count_if(F.col(col) > F.lit(factor) * thr).alias("n_outliers")).select(
        F.round(thr, 4).alias("p99_gross"), "n_outliers")


def target_correlation(df: DataFrame, columns: list[str] | None = None, y: str = TARGET, top: int = 10) -> DataFrame:
    """Pearson r per column with the target in one aggregate; top by |r|."""
    cols = [c for c in (columns or OPERATIONAL) if c in df.columns]
    wide = df.agg(*[F.corr(finite_or_null(F.col(c)), finite_or_null(F.col(y))).alias(c) for c in cols])
    long = _unpivot_row(wide, cols, "feature", "r")
    return (long.orderBy(F.abs("r").desc_nulls_last(), "feature").limit(top)
            .select("feature", F.round("r", 4).alias("corr_with_target")))


def feature_skewness(df: DataFrame, columns: list[str] | None = None, top: int = 10) -> DataFrame:
    """Bias-corrected sample skewness (pandas' definition), top by |skew|."""
    cols = [c for c in (columns or OPERATIONAL) if c in df.columns]
    aggs = []
    for c in cols:
        v = finite_or_null(F.col(c))
        n = F.count(v).cast("double")
        adj = F.sqrt(n * (n - 1)) / (n - 2)
        aggs.append(F.when(n >= 3, F.skewness(v) * adj).alias(c))
    long = _unpivot_row(df.agg(*aggs), cols, "feature", "s")
    return (long.orderBy(F.abs("s").desc_nulls_last(), "feature").limit(top)
            .select("feature", F.round("s", 3).alias("skewness")))


def train_medians(train: DataFrame) -> DataFrame:
    """(feature, median) of finite values, training frame only."""
    stats = fit_statistics(train)
    names = [c[len("median__"):] for c in stats.columns if c.startswith("median__")]
    wide = stats.select(*[F.col(f"median__{n}").alias(n) for n in names])
    return _unpivot_row(wide, names, "feature", "median")


def baseline_comparison(scored: DataFrame, block: str = "test") -> DataFrame:
    """L11 input: one metric row per baseline on the chosen block."""
    rows = scored.where(F.col("split") == block)
    a = metrics_overall(rows, TARGET, PREDICTION).select(F.lit("naive_prior").alias("model"), *METRIC_NAMES)
    b = metrics_overall(rows, TARGET, "pred_seasonal").select(
        F.lit("seasonal_naive").alias("model"), *METRIC_NAMES)
    return a.unionByName(b)


def retrain_trigger(scored: DataFrame, tolerance: float = 0.10, sustained: int = 3,
                    drift_band: float = 0.25) -> DataFrame:
    """Per evaluation month, two signals against the training period:
    accuracy (WAPE worse than (1 + tolerance) x the training WAPE) and
    prediction drift (PSI of the month's predictions vs the training
    predictions at or above the "drifted" band). Retrain after ``sustained``
    consecutive months with either breach.

    One aggregate to month grain; the reference level and the run length are
    windows over that month table (one row per month whatever the volume).
    """
    from closecast.operators.drift import psi_by_group

    err = F.abs(F.col(TARGET) - F.col(PREDICTION))
    monthly = scored.groupBy(MONTH, "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(err).alias("e"), F.sum(F.abs(TARGET)).alias("a"))
    everything = Window.partitionBy()
    is_train = F.col("split") == "train"
    ref = (F.sum(F.when(is_train, F.col("e"))).over(everything)
           / F.sum(F.when(is_train, F.col("a"))).over(everything))
    m = monthly.withColumn("ref_wape", ref).where(~is_train).withColumn(
        "wape", F.when(F.col("a") >= 1e-9, F.col("e") / F.col("a")))
    drift = psi_by_group(scored.where(F.col("split") == "train"), scored.where(F.col("split") != "train"),
                         PREDICTION, MONTH)
    m = m.join(drift, MONTH, "left")
    accuracy_breach = F.coalesce(F.col("wape") > (1 + tolerance) * F.col("ref_wape"), F.lit(False))
    drift_breach = F.coalesce(F.col("psi") >= drift_band, F.lit(False))
    w = Window.orderBy(MONTH).rowsBetween(-(sustained - 1), 0)
    m = m.withColumn("breach", accuracy_breach | drift_breach)
    n_breach = F.sum(F.col("breach").cast("int")).over(w).cast("bigint")
    return m.select(MONTH, "n", F.round("wape", 6).alias("wape"), F.round("ref_wape", 6).alias("reference_wape"),
                    F.round("psi", 6).alias("prediction_psi"), accuracy_breach.alias("accuracy_breach"),
                    drift_breach.alias("drift_breach"), "breach",
                    n_breach.alias("breaches_last_3"), (n_breach >= sustained).alias("retrain"))
