"""Month-based temporal splits and backtest folds.

Months are a short, bounded list (one per accounting month, not per row), so
they are collected to the driver once; row membership is then a literal
``isin`` (an InSet filter that prunes ``accounting_month`` partitions) or a
join against a small fold-calendar DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.schema import MONTH, N_BACKTEST_FOLDS, N_TEST_MONTHS, N_VAL_MONTHS


# fixed values: the names of the split strategies
STRATEGIES = ("blocked_temporal", "rolling_origin", "expanding_window")


@dataclass(frozen=True)
class SplitConfig:
    n_test_months: int = N_TEST_MONTHS
    n_val_months: int = N_VAL_MONTHS
    n_backtest_folds: int = N_BACKTEST_FOLDS
    strategy: str = "blocked_temporal"

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown split strategy {self.strategy!r}; known: {', '.join(STRATEGIES)}")
        for v in (self.n_test_months, self.n_val_months, self.n_backtest_folds):
            if v < 1:
                raise ValueError("split month/fold counts must be >= 1")


@dataclass
class TemporalSplit:
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    train_months: list[str]
    validation_months: list[str]
    test_months: list[str]


def ordered_months(df: DataFrame) -> list[str]:
    """Sorted distinct non-null months (a bounded list)."""
    rows = df.where(F.col(MONTH).isNotNull()).select(F.col(MONTH).cast("string").alias("m")).distinct().collect()
    return sorted(r["m"] for r in rows)


def blocked_months(months: list[str], config: SplitConfig | None = None) -> tuple[list[str], list[str], list[str]]:
    config = config or SplitConfig()
    n_test, n_val = config.n_test_months, config.n_val_months
    if len(months) <= n_test + n_val:
        raise ValueError(f"Not enough months ({len(months)}) for {n_val} validation + {n_test} test months")
    return months[: -(n_test + n_val)], months[-(n_test + n_val):-n_test], months[-n_test:]


def blocked_temporal_split(df: DataFrame, config: SplitConfig | None = None) -> TemporalSplit:
    """Last n_test months = test, the n_val before = validation, rest = train."""
    train_m, val_m, test_m = blocked_months(ordered_months(df), config)
    month = F.col(MONTH)
    return TemporalSplit(
        train=df.where(month.isin(train_m)), validation=df.where(month.isin(val_m)),
        test=df.where(month.isin(test_m)),
        train_months=train_m, validation_months=val_m, test_months=test_m,
    )


def with_split_column(df: DataFrame, config: SplitConfig | None = None) -> DataFrame:
    """T1 as one column: ``split`` in train / validation / test (no row copies)."""
    train_m, val_m, test_m = blocked_months(ordered_months(df), config)
    month = F.col(MONTH)
    split = (F.when(month.isin(test_m), F.lit("test"))
             .when(month.isin(val_m), F.lit("validation"))
             .when(month.isin(train_m), F.lit("train")))
    return df.withColumn("split", split)


def split_summary(df: DataFrame, config: SplitConfig | None = None) -> DataFrame:
    """T4: per block: rows, number of months, first/last month and month list."""
    return (
        with_split_column(df, config).groupBy("split")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(MONTH).alias("n_months"),
             F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"),
             F.array_join(F.array_sort(F.collect_set(MONTH)), ",").alias("months"))
    )


def rolling_fold_windows(n_months: int, config: SplitConfig | None = None) -> list[tuple[int, int, int, int]]:
    """T2 calendar as index ranges ``(train_lo, train_hi, val_lo, val_hi)`` (half-open)."""
    config = config or SplitConfig()
    h, k = config.n_val_months, config.n_backtest_folds
    min_train = max(h, n_months - k * h)
    out = []
    for f in range(k):
        end = min_train + f * h
        if end + h > n_months:
            break
        out.append((max(0, end - min_train), end, end, end + h))
    return out


def expanding_fold_windows(n_months: int, config: SplitConfig | None = None) -> list[tuple[int, int, int, int]]:
    """T3 calendar as index ranges."""
    config = config or SplitConfig()
    h, k = config.n_val_months, config.n_backtest_folds
    first = n_months - k * h
    if first < 1:
        first = h
    out = []
    for f in range(k):
        end = first + f * h
        if end + h > n_months:
            break
        out.append((0, end, end, end + h))
    return out


def temporal_splits(df: DataFrame, config: SplitConfig | None = None) -> list[TemporalSplit]:
    """The splits of ``config.strategy``: one blocked split, or one a fold, whose validation months are its test months too.

    Too few months for a split or a fold are an error.
    """
    config = config or SplitConfig()
    if config.strategy == "blocked_temporal":
        return [blocked_temporal_split(df, config)]
    months, month = ordered_months(df), F.col(MONTH)
    windows = (rolling_fold_windows if config.strategy == "rolling_origin" else expanding_fold_windows)(len(months), config)
    if not windows:
        raise ValueError(f"Not enough months ({len(months)}) for a fold of {config.n_val_months} validation months")
    out = []
    for lo, hi, vlo, vhi in windows:
        held = df.where(month.isin(months[vlo:vhi]))
        out.append(TemporalSplit(df.where(month.isin(months[lo:hi])), held, held, months[lo:hi], months[vlo:vhi], months[vlo:vhi]))
    return out


def fold_calendar(df: DataFrame, kind: str = "expanding", config: SplitConfig | None = None) -> DataFrame:
    """(fold_id, role, accounting_month) rows for T2 (``rolling``) or T3 (``expanding``)."""
    months = ordered_months(df)
    windows = (rolling_fold_windows if kind == "rolling" else expanding_fold_windows)(len(months), config)
    rows = []
    for fold, (tlo, thi, vlo, vhi) in enumerate(windows):
        rows += [(fold, "train", m) for m in months[tlo:thi]]
        rows += [(fold, "validation", m) for m in months[vlo:vhi]]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "fold_id int, role string, accounting_month string")


def backtest_folds(df: DataFrame, kind: str = "expanding", config: SplitConfig | None = None) -> DataFrame:
    """Rows tagged with ``fold_id`` and ``role``; a row appears once per fold it belongs to.

    The calendar has one row per (fold, month): it is bounded by the number of
    months, so it is broadcast.
    """
    cal = fold_calendar(df, kind, config)
    return df.join(F.broadcast(cal), MONTH, "inner")


def backtest_summary(df: DataFrame, kind: str = "expanding", config: SplitConfig | None = None) -> DataFrame:
    return (
        backtest_folds(df, kind, config).groupBy("fold_id", "role")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(MONTH).alias("n_months"),
             F.min(MONTH).alias("first_month"), F.max(MONTH).alias("last_month"))
    )
