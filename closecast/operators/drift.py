"""Distribution drift (PSI, Jensen-Shannon), data-quality drift, retrain rule.

All features are handled in one pass: both frames are unpivoted to
``(feature, x)``; decile edges of the reference are exact
distributed quantiles; each value's bin is the count of inner edges <= x
(edges are a short array per feature, broadcast with the feature table); one
grouped count gives both histograms. A complete bin list per feature makes
empty bins explicit, so the rate clipping matches the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closecast.functions.quantiles import bin_of, quantile_table
from closecast.schema import DIMENSIONS

BINS = 10
RATE_FLOOR = 1e-6
STABLE_BELOW = 0.1
MODERATE_BELOW = 0.25


def quantile_levels(bins: int = BINS) -> list[float]:
    """Evenly spaced levels 0..1 (the last one exactly 1.0)."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _number(c):
    """The values of a column that count: only NaN / NULL are dropped (infinities stay, as in the reference)."""
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def _long(df: DataFrame, columns: list[str], side: str) -> DataFrame:
    cols = [c for c in columns if c in df.columns]
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), _number(F.col(f"`{c}`")).alias("x")) for c in cols
    ])).alias("s")).select("s.feature", "s.x")
    return stacked.where(F.col("x").isNotNull()).withColumn("side", F.lit(side))


def _raw_counts(reference: DataFrame, current: DataFrame, feats: list[str], bins: int,
                relative_error: float | None) -> tuple[DataFrame, DataFrame]:
    """(per (feature, bin) counts of both sides, per-feature edges). Features
    whose reference has a single distinct value land in bin 0."""
    ref = _long(reference, feats, "ref")
    cur = _long(current, feats, "cur")
    held = {c: _number(F.col(f"`{c}`")) for c in feats}
    edges = quantile_table(reference, held, quantile_levels(bins), relative_error).select(
        "feature", F.array_distinct("q").alias("edges"))
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    edges = edges.select("feature", F.size("edges").alias("n_edges"), inner.alias("inner"))
    both = ref.unionByName(cur).join(F.broadcast(edges), "feature", "inner")
    bin_idx = bin_of(F.col("x"), F.col("inner"), bins - 1)
    counts = both.groupBy("feature", bin_idx.alias("bin")).agg(
        F.count_if(F.col("side") == "ref").alias("expected"),
        F.count_if(F.col("side") == "cur").alias("actual"))
    return counts, edges


def binned_counts(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = BINS,
                  relative_error: float | None = None) -> DataFrame:
    """Per (feature, bin): expected / actual counts over a complete bin list,
    plus n_edges and the per-side totals (from the small per-bin table, so the
    rows are unpivoted and scanned once)."""
    feats = [c for c in columns if c in reference.columns and c in current.columns]
    counts, edges = _raw_counts(reference, current, feats, bins, relative_error)
    totals = counts.groupBy("feature").agg(F.sum("expected").alias("n_ref"), F.sum("actual").alias("n_cur"))
    grid = edges.where(F.col("n_edges") >= 2).select(
        "feature", "n_edges", F.explode(F.sequence(F.lit(0), F.col("n_edges") - 2)).alias("bin"))
    return (grid.join(counts, ["feature", "bin"], "left").join(totals, "feature", "left")
            .select("feature", "bin", "n_edges",
                    F.coalesce("expected", F.lit(0)).alias("expected"),
                    F.coalesce("actual", F.lit(0)).alias("actual"), "n_ref", "n_cur"))


def psi_by_feature(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = BINS,
                   relative_error: float | None = None) -> DataFrame:
    """D1 for every column: ``feature, psi`` (NULL when either side is empty,
    0.0 when the reference has fewer than two distinct edges)."""
    feats = [c for c in columns if c in reference.columns and c in current.columns]
    spark = reference.sparkSession
    counts, edges = _raw_counts(reference, current, feats, bins, relative_error)
    totals = counts.groupBy("feature").agg(F.sum("expected").alias("n_ref"), F.sum("actual").alias("n_cur"))
    grid = edges.where(F.col("n_edges") >= 2).select(
        "feature", F.explode(F.sequence(F.lit(0), F.col("n_edges") - 2)).alias("bin"))
    full = grid.join(counts, ["feature", "bin"], "left").join(totals, "feature")
    e = F.greatest(F.try_divide(F.coalesce(F.col("expected"), F.lit(0)), F.col("n_ref")), F.lit(RATE_FLOOR))
    a = F.greatest(F.try_divide(F.coalesce(F.col("actual"), F.lit(0)), F.col("n_cur")), F.lit(RATE_FLOOR))
    psi = full.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    all_feats = spark.createDataFrame([(f,) for f in feats], "feature string")
    out = all_feats.join(totals, "feature", "left").join(psi, "feature", "left")
    value = (F.when(F.coalesce(F.col("n_ref"), F.lit(0)) == 0, F.lit(None).cast("double"))
             .when(F.coalesce(F.col("n_cur"), F.lit(0)) == 0, F.lit(None).cast("double"))
             .otherwise(F.coalesce(F.col("psi"), F.lit(0.0))))
    return out.select("feature", value.alias("psi"))


def status_of(psi_col) -> F.Column:
    """D3: stable / moderate / drifted; NULL -> unknown."""
    return (F.when(psi_col.isNull(), F.lit("unknown"))
            .when(psi_col < STABLE_BELOW, F.lit("stable"))
            .when(psi_col < MODERATE_BELOW, F.lit("moderate"))
            .otherwise(F.lit("drifted")))


def drift_report(reference: DataFrame, current: DataFrame, columns: list[str], **kw) -> DataFrame:
    """D2 long form: ``feature, psi, status`` (per-feature status)."""
    p = psi_by_feature(reference, current, columns, **kw)
    return p.withColumn("status", status_of(F.col("psi")))


def drift_summary(report: DataFrame) -> DataFrame:
    """D2 summary: ``n_features, max_psi`` (over non-NULL), overall ``status``."""
    s = report.agg(F.count(F.lit(1)).alias("n_features"), F.max("psi").alias("max_psi"))
    return s.withColumn("status", status_of(F.col("max_psi")))


def js_distance(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """Jensen-Shannon distance per feature on the same bins (natural log).

    Every feature has a row: 0.0 where the reference has a single edge, NULL
    where either side has no values.
    """
    feats = [c for c in columns if c in reference.columns and c in current.columns]
    counts = binned_counts(reference, current, columns, bins)
    p = F.try_divide(F.col("expected"), F.col("n_ref"))
    q = F.try_divide(F.col("actual"), F.col("n_cur"))
    m = (p + q) / 2

    def kl_term(x):
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))

    js = counts.groupBy("feature").agg(F.sum(0.5 * kl_term(p) + 0.5 * kl_term(q)).alias("js"))
    sides = reference.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    for name, df in (("has_ref", reference), ("has_cur", current)):
        seen = df.agg(*[F.count(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None))).alias(f) for f in feats])
        sides = sides.join(seen.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"`{f}`") > 0).alias(name)) for f in feats])).alias("s"))
                           .select("s.*"), "feature", "left")
    value = F.when(F.col("has_ref") & F.col("has_cur"), F.coalesce(F.sqrt(F.greatest(F.col("js"), F.lit(0.0))), F.lit(0.0)))
    return sides.join(js, "feature", "left").select("feature", value.alias("js_distance"))


def missing_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """M14 core: per column, missing count and share (NaN counts as missing)."""
    n = F.count(F.lit(1))
    aggs = []
    for c in columns:
        col = F.col(f"`{c}`")
        miss = col.isNull() | (F.isnan(col) if dict(df.dtypes)[c] in ("double", "float") else F.lit(False))
        aggs.append(F.count_if(miss).alias(c))
    wide = df.agg(n.alias("__n"), *aggs)
    return wide.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing")) for c in columns
    ])).alias("s")).select("s.column", "s.missing", F.col("__n").alias("n"))


def data_quality_drift(reference: DataFrame, current: DataFrame, columns: list[str],
                       tolerance: float = 0.05) -> DataFrame:
    """Rising missingness per column and categories unseen in the reference.

    Rows: ``check, column, reference_value, current_value, drifted``.
    """
    cols = [c for c in columns if c in reference.columns and c in current.columns]
    r = missing_shares(reference, cols).select("column", F.try_divide(F.col("missing"), F.col("n")).alias("ref_share"))
    c = missing_shares(current, cols).select("column", F.try_divide(F.col("missing"), F.col("n")).alias("cur_share"))
    miss = r.join(c, "column").select(
        F.lit("missing_share").alias("check"), "column",
        F.round("ref_share", 6).alias("reference_value"), F.round("cur_share", 6).alias("current_value"),
        (F.col("cur_share") - F.col("ref_share") > tolerance).alias("drifted"))
    dims = [d for d in DIMENSIONS if d in reference.columns and d in current.columns]
    parts = [miss]
    for d in dims:
        ref_c = reference.select(F.col(d).cast("string").alias("category")).where("category IS NOT NULL").distinct()
        cur_c = current.select(F.col(d).cast("string").alias("category")).where("category IS NOT NULL").distinct()
        new = cur_c.join(ref_c, "category", "left_anti").agg(F.count(F.lit(1)).alias("n_new"))
        parts.append(new.select(F.lit("new_categories").alias("check"), F.lit(d).alias("column"),
                                F.lit(0.0).alias("reference_value"), F.col("n_new").cast("double").alias("current_value"),
                                (F.col("n_new") > 0).alias("drifted")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def psi_by_group(reference: DataFrame, current: DataFrame, col: str, group_col: str, bins: int = BINS,
                 relative_error: float | None = None) -> DataFrame:
    """PSI of ``col`` for every group of ``current`` (e.g. each month) against
    one reference distribution. The reference edges (at most ``bins`` + 1
    values) are computed once; each group's counts come from one grouped
    aggregate over a complete (group, bin) grid."""
    x = F.col(col).cast("double")
    ref = reference.select(_number(x).alias("x")).where(F.col("x").isNotNull())
    cur = current.select(F.col(group_col).alias("g"), x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    found = quantile_table(reference, {col: _number(x)}, quantile_levels(bins), relative_error).select(
        F.array_distinct("q").alias("e")).first()  # <= bins + 1 values
    edges = found["e"] if found else None
    groups = current.select(F.col(group_col).alias("g")).distinct()
    if not edges:
        return groups.select("g", F.lit(None).cast("double").alias("psi")).withColumnRenamed("g", group_col)
    if len(edges) < 2:
        return groups.select(F.col("g").alias(group_col), F.lit(0.0).alias("psi"))
    inner = F.array(*[F.lit(e) for e in edges[1:-1]])
    nb = len(edges) - 1
    bin_idx = bin_of(F.col("x"), inner, len(edges) - 2)
    ref_counts = ref.groupBy(bin_idx.alias("bin")).agg(F.count(F.lit(1)).alias("expected"))
    n_ref = ref_counts.agg(F.sum("expected")).first()[0]
    cur_counts = cur.groupBy("g", bin_idx.alias("bin")).agg(F.count(F.lit(1)).alias("actual"))
    n_cur = cur.groupBy("g").agg(F.count(F.lit(1)).alias("n_cur"))
    grid = groups.select("g", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("bin"))
    full = (grid.join(F.broadcast(ref_counts), "bin", "left").join(cur_counts, ["g", "bin"], "left")
            .join(n_cur, "g", "left"))
    e = F.greatest(F.coalesce(F.col("expected"), F.lit(0)) / F.lit(float(n_ref)), F.lit(RATE_FLOOR))
    a = F.greatest(F.try_divide(F.coalesce(F.col("actual"), F.lit(0)), F.col("n_cur")), F.lit(RATE_FLOOR))
    psi = full.groupBy("g").agg(F.sum((a - e) * F.log(a / e)).alias("psi"), F.max("n_cur").alias("n_cur"))
    return psi.select(F.col("g").alias(group_col),
                      F.when(F.coalesce(F.col("n_cur"), F.lit(0)) == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("psi")).alias("psi"))


def contract_failure_drift(reference: DataFrame, current: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Share of rows that break the contract, reference against current, per column and over all.

    Rows: ``column, reference_rate, current_rate, drifted``; the column ``*`` counts a row once however many rules it breaks.
    """
    from closecast.operators.contracts import with_contract_failures

    def rates(df: DataFrame, name: str) -> DataFrame:
        checked = with_contract_failures(df).select(F.array_distinct(F.transform("contract_failures", lambda x: x["column"])).alias("columns"))
        broken = F.when(F.size("columns") > 0, F.concat(F.array(F.lit("*")), "columns")).otherwise(F.array(F.lit("*")))
        # a row per row and broken column, added up before the shuffle; the star's rows are all rows
        long = checked.select(F.explode(broken).alias("column"), (F.size("columns") > 0).alias("bad"))
        per = long.groupBy("column").agg(F.count_if("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
        total = per.where(F.col("column") == "*").select(F.col("n").alias("total"))
        return per.crossJoin(total).select("column", (F.col("bad") / F.col("total")).alias(name))  # one total

    both = rates(reference, "r").join(rates(current, "c"), "column", "full")
    r, c = (F.coalesce(x, F.lit(0.0)) for x in ("r", "c"))
    return both.select("column", F.round(r, 6).alias("reference_rate"), F.round(c, 6).alias("current_rate"), (c - r > tolerance).alias("drifted"))


def schema_fingerprint(df: DataFrame) -> dict[str, str]:
    """Column names with their types, as kept for every accepted batch."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def keep_fingerprint(df: DataFrame, batch: str, path: str) -> None:
    """Append the batch's schema to the ledger at ``path`` (a row per column)."""
    rows = [(batch, c, t) for c, t in schema_fingerprint(df).items()]
    df.sparkSession.createDataFrame(rows, "batch string, column string, type string").coalesce(1).write.mode("append").parquet(path)


def schema_changes(ledger: DataFrame) -> DataFrame:
    """Per batch, against the batch before: columns added, removed and of another type; ``retrain`` if any.

    The ledger has a row per batch and column, whatever the rows of the batches.
    """
    batches = ledger.select("batch").distinct().select("batch", F.lag("batch").over(Window.partitionBy(F.lit(1)).orderBy("batch")).alias("before")).where("before IS NOT NULL")
    now = batches.join(ledger, "batch").select("batch", "before", "column", F.col("type").alias("now"))
    was = batches.join(ledger.withColumnRenamed("batch", "before"), "before").select("batch", "before", "column", F.col("type").alias("was"))
    both = now.join(was, ["batch", "before", "column"], "full")
    named = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("column")))), ",")
    out = both.groupBy("batch").agg(named(F.col("was").isNull()).alias("added"), named(F.col("now").isNull()).alias("removed"),
                                    named(F.col("now") != F.col("was")).alias("changed"))
    return out.withColumn("retrain", F.concat("added", "removed", "changed") != "")
