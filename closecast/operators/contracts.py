"""Data contract and leakage rules, evaluated in one pass per table.

Failures are data, not exceptions: every rule is a boolean Column, failing
rows are exploded into a long failure table ``(keys, column, check,
failure_case)``. Raising is a thin driver-side wrapper on top (counts only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closecast.schema import (
    DATE_PATTERN,
    DIMENSIONS,
    FACILITY,
    FACILITY_PATTERN,
    FORBIDDEN_FUTURE,
    HISTORICAL,
    KEYS,
    MONTH,
    MONTH_PATTERN,
    MTD_MEASURES,
    SNAPSHOT_DATE,
    SNAPSHOT_DAY,
    TARGET,
)


class ContractViolation(ValueError):
    """Raised when a frame violates the data contract."""


@dataclass(frozen=True)
class Rule:
    column: str
    check: str
    nullable: bool
    predicate: str | None  # SQL predicate over `v` that must hold for non-null values


def contract_rules(require_target: bool = True) -> list[Rule]:
    """The declared rules, in column order."""
    rules = [
        Rule(FACILITY, f"str_matches('{FACILITY_PATTERN}')", False, f"v RLIKE '{FACILITY_PATTERN}'"),
        Rule(MONTH, f"str_matches('{MONTH_PATTERN}')", False, f"v RLIKE '{MONTH_PATTERN}'"),
        Rule(SNAPSHOT_DATE, f"str_matches('{DATE_PATTERN}')", False, f"v RLIKE '{DATE_PATTERN}'"),
        Rule(SNAPSHOT_DAY, "in_range(1, 31)", False, "v BETWEEN 1 AND 31"),
    ]
    rules += [Rule(c, "", False, None) for c in DIMENSIONS]
    rules += [Rule(c, "greater_than_or_equal_to(0)", True, "v >= 0") for c in MTD_MEASURES]
    rules += [
        Rule("days_elapsed", "in_range(1, 31)", False, "v BETWEEN 1 AND 31"),
        Rule("business_days_elapsed", "greater_than_or_equal_to(0)", False, "v >= 0"),
        Rule("remaining_days", "greater_than_or_equal_to(0)", False, "v >= 0"),
    ]
    rules += [Rule(c, "", True, None) for c in HISTORICAL if c not in ("month", "quarter")]
    rules += [
        Rule("month", "in_range(1, 12)", False, "v BETWEEN 1 AND 12"),
        Rule("quarter", "in_range(1, 4)", False, "v BETWEEN 1 AND 4"),
    ]
    if require_target:
        rules.append(Rule(TARGET, "greater_than(0)", False, "v > 0"))
    return rules


def _value(df: DataFrame, c: str) -> Column:
    """Column value with NaN treated as missing (contract semantics)."""
    col = F.col(f"`{c}`")
    if dict(df.dtypes)[c] in ("double", "float"):
        return F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col


def _failure_structs(df: DataFrame, require_target: bool) -> list[Column]:
    out = []
    present = set(df.columns)
    for r in contract_rules(require_target):
        if r.column not in present:
            continue
        v = _value(df, r.column)
        if not r.nullable:
            out.append(F.when(v.isNull(), F.struct(F.lit(r.column).alias("column"),
                                                   F.lit("not_nullable").alias("check"),
                                                   F.lit(None).cast("string").alias("failure_case"))))
        if r.predicate is not None:
            holds = _holds(r, v)
            out.append(F.when(v.isNotNull() & ~F.coalesce(holds, F.lit(False)),
                              F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                                       v.cast("string").alias("failure_case"))))
    return out


def _holds(rule: Rule, v: Column) -> Column:
    """Evaluate the rule's predicate on value ``v``."""
    kind = rule.check.split("(")[0]
    if kind == "str_matches":
        return v.rlike(rule.predicate.split("RLIKE ")[1].strip("'"))
    if kind == "in_range":
        lo, hi = (int(x) for x in rule.check[len("in_range("):-1].split(","))
        return v.between(lo, hi)
    if kind == "greater_than_or_equal_to":
        return v >= 0
    if kind == "greater_than":
        return v > 0
    raise ValueError(rule.check)


def with_contract_failures(df: DataFrame, require_target: bool = True) -> DataFrame:
    """Adds ``contract_failures``: array<struct<column, check, failure_case>>."""
    structs = _failure_structs(df, require_target)
    arr = F.filter(F.array(*structs), lambda x: x.isNotNull()) if structs else F.array()
    return df.withColumn("contract_failures", arr)


def missing_columns(df: DataFrame, require_target: bool = True) -> list[str]:
    """C1d: declared columns absent from the frame (extra columns are fine)."""
    present = set(df.columns)
    declared: list[str] = []
    for r in contract_rules(require_target):
        if r.column not in declared:
            declared.append(r.column)
    return [c for c in declared if c not in present]


def contract_failures(df: DataFrame, require_target: bool = True) -> DataFrame:
    """Long failure table, one row per (row, failed rule). No shuffle."""
    keys = [k for k in KEYS if k in df.columns]
    checked = with_contract_failures(df, require_target)
    return checked.select(*[F.col(k).cast("string").alias(k) for k in keys],
                          F.inline("contract_failures"))


def quarantine(df: DataFrame, require_target: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split good and bad rows instead of failing the whole batch.

    Bad rows keep a ``contract_failures`` text column ``column:check;...``.
    """
    checked = with_contract_failures(df, require_target)
    text = F.array_join(F.transform("contract_failures", lambda x: F.concat(x["column"], F.lit(":"), x["check"])), ";")
    good = checked.where(F.size("contract_failures") == 0).drop("contract_failures")
    bad = checked.where(F.size("contract_failures") > 0).withColumn("contract_failures", text)
    return good, bad


def accepted_rows(df: DataFrame, quarantine_path: str | None = None, require_target: bool = True) -> tuple[DataFrame, int]:
    """The rows that meet the contract, and how many do not.

    Without a path any failing row raises. With one, failing rows are written
    there with their reasons, so accepted + written = input.
    """
    if quarantine_path is None:
        return validate_raw_snapshots(df, require_target), 0
    missing = missing_columns(df, require_target)
    if missing:
        raise ContractViolation(f"snapshot contract: missing columns {missing}")
    good, bad = quarantine(df, require_target)
    bad.write.mode("overwrite").parquet(quarantine_path)
    return good, df.sparkSession.read.parquet(quarantine_path).count()


def validate_raw_snapshots(df: DataFrame, require_target: bool = True) -> DataFrame:
    """C1 as a gate: raise with counts when any rule fails, else return df."""
    missing = missing_columns(df, require_target)
    if missing:
        raise ContractViolation(f"snapshot contract: missing columns {missing}")
    # one row per declared rule at most
    rows = contract_failures(df, require_target).groupBy("column", "check").count().orderBy("column", "check").collect()
    if rows:
        detail = ", ".join(f"{r['column']}:{r['check']}={r['count']}" for r in rows)
        raise ContractViolation(f"snapshot contract: {detail}")
    return df


# -- leakage rules (C2-C6, C8) ------------------------------------------------
LEAK_MESSAGES = {
    "unparseable_date": "some values of snapshot_date are not dates",
    "day_matches_date": "snapshot_day is not the day of the month in snapshot_date",
    "date_in_month": "snapshot_date lies in another month than accounting_month",
    "days_elapsed": "days_elapsed is not snapshot_day: the row may know later days",
    "target_constant": "target varies inside facility-month [{offenders}]",
}


def leakage_report(df: DataFrame) -> DataFrame:
    """One row per leakage rule: ``rule, violations, message`` (message NULL if it passes).

    C2/C3 are skipped (violations NULL) when any date is unparseable, as in
    the reference. C5 uses ``min <> max`` per facility-month (one partial
    aggregate), and names the first three offenders in key order.
    """
    d = F.expr(f"try_to_date(`{SNAPSHOT_DATE}`, 'yyyy-MM-dd')")
    day_ok = F.coalesce(F.dayofmonth(d) == F.col(SNAPSHOT_DAY), F.lit(False))
    month_ok = F.coalesce(F.date_format(d, "yyyy-MM") == F.col(MONTH), F.lit(False))
    has_elapsed = "days_elapsed" in df.columns
    elapsed_ok = (F.coalesce(F.col("days_elapsed").cast("double") == F.col(SNAPSHOT_DAY).cast("double"), F.lit(False))
                  if has_elapsed else F.lit(True))
    row_level = df.agg(
        F.count_if(d.isNull()).alias("unparseable_date"),
        F.count_if(~day_ok).alias("day_matches_date"),
        F.count_if(~month_ok).alias("date_in_month"),
        F.count_if(~elapsed_ok).alias("days_elapsed"),
    )
    parts = []
    for rule in ["unparseable_date", "day_matches_date", "date_in_month", "days_elapsed"]:
        n = F.col(rule).cast("bigint")
        if rule in ("day_matches_date", "date_in_month"):
            n = F.when(F.col("unparseable_date") > 0, F.lit(None).cast("bigint")).otherwise(n)
        if rule == "days_elapsed" and not has_elapsed:
            n = F.lit(None).cast("bigint")
        msg = F.when(n > 0, F.lit(LEAK_MESSAGES[rule]))
        parts.append(row_level.select(F.lit(rule).alias("rule"), n.alias("violations"), msg.alias("message")))

    if TARGET in df.columns:
        t = F.when(F.isnan(TARGET), F.lit(None)).otherwise(F.col(TARGET))
        groups = (
            df.where(F.col(FACILITY).isNotNull() & F.col(MONTH).isNotNull())
            .groupBy(FACILITY, MONTH).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
            .where(F.col("lo") != F.col("hi"))
        )
        label = F.concat(F.lit("('"), F.col(FACILITY), F.lit("', '"), F.col(MONTH), F.lit("')"))
        first3 = groups.orderBy(FACILITY, MONTH).limit(3).select(label.alias("o"), FACILITY, MONTH)
        offenders = first3.agg(F.array_join(F.array_sort(F.collect_list("o")), ", ").alias("o"))
        count = groups.agg(F.count(F.lit(1)).alias("n"))
        # two one-row aggregates combined by union + max (no cross join)
        both = (count.select(F.col("n"), F.lit(None).cast("string").alias("o"))
                .unionByName(offenders.select(F.lit(None).cast("bigint").alias("n"), "o"))
                .agg(F.max("n").alias("n"), F.max("o").alias("o")))
        msg = F.when(F.col("n") > 0, F.concat(F.lit("target varies inside facility-month ["), F.col("o"), F.lit("]")))
        parts.append(both.select(F.lit("target_constant").alias("rule"), F.col("n").alias("violations"),
                                 msg.alias("message")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_leakage_rules(df: DataFrame) -> DataFrame:
    """Raise one error naming every failing rule ("; "-joined), else return df."""
    rows = leakage_report(df).collect()
    order = list(LEAK_MESSAGES)
    msgs = [r["message"] for r in sorted(rows, key=lambda r: order.index(r["rule"])) if r["message"]]
    if msgs:
        raise ContractViolation("; ".join(msgs))
    return df


def check_forbidden(columns: list[str], forbidden: list[str] | None = None) -> None:
    """Post-close columns must not reach a feature builder."""
    present = [c for c in (forbidden or FORBIDDEN_FUTURE) if c in columns]
    if present:
        raise ValueError(f"Forbidden feature inputs {present}: their values exist only once the month is closed")


# -- coercion (C1 "coerce, then check") ---------------------------------------
def coerce_to_schema(df: DataFrame, require_target: bool = True) -> DataFrame:
    """Cast every declared column to its contract type with ``try_cast``.

    A value that is present but does not parse becomes NULL and is recorded in
    ``coerce_failures`` (array of struct<column, check, failure_case>), so the
    failure table can report it instead of silently losing it.
    """
    from closecast.schema import snapshot_schema

    types = {f.name: f.dataType.simpleString() for f in snapshot_schema(require_target).fields}
    casts, fails = {}, []
    for c in df.columns:
        if c not in types:
            continue
        src = F.col(f"`{c}`")
        cast = src.try_cast(types[c])
        casts[c] = cast
        bad = src.isNotNull() & cast.isNull()
        fails.append(F.when(bad, F.struct(F.lit(c).alias("column"),
                                          F.lit(f"coerce_dtype('{types[c]}')").alias("check"),
                                          src.cast("string").alias("failure_case"))))
    arr = F.filter(F.array(*fails), lambda x: x.isNotNull()) if fails else F.array()
    return df.withColumn("coerce_failures", arr).withColumns(casts)


def coerced_contract_failures(df: DataFrame, require_target: bool = True) -> DataFrame:
    """C1 on untyped input (e.g. CSV read as text): coercion failures first,
    then the value rules on the coerced columns; one long failure table."""
    checked = with_contract_failures(coerce_to_schema(df, require_target), require_target)
    keys = [k for k in KEYS if k in df.columns]
    both = F.concat(F.col("coerce_failures"), F.col("contract_failures"))
    return checked.select(*[F.col(k).cast("string").alias(k) for k in keys], F.inline(both))
