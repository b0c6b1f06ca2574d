"""Comparison table, champion / challenger, promotion gate.

The comparison table has one row per candidate, so ranking it is a tiny
window; only the ranked names come back to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closecast.operators.metrics import METRIC_NAMES, metric_exprs
from closecast.schema import CHALLENGER_THRESHOLD, SNAPSHOT_DAY, TARGET


def comparison_table(metric_rows: dict[str, DataFrame]) -> DataFrame:
    """Stack one-row metric frames, tagged with the model name."""
    out = None
    for name, row in metric_rows.items():
        r = row.select(F.lit(name).alias("model"), *METRIC_NAMES)
        out = r if out is None else out.unionByName(r)
    return out


def ranked(table: DataFrame, metric: str = "wape") -> DataFrame:
    """Rank 1 = champion. Ascending (descending for r2), NULL last,
    model name breaks ties so the order is deterministic."""
    order = F.col(metric).desc_nulls_last() if metric == "r2" else F.col(metric).asc_nulls_last()
    w = Window.orderBy(order, F.col("model"))
    return table.withColumn("rank", F.row_number().over(w)).withColumn("is_champion", F.col("rank") == 1)


@dataclass
class Selection:
    champion: str
    challenger: str | None
    ranking: DataFrame
    metric: str
    challenger_promotable: bool


def improvement(champ: float, chall: float, metric: str) -> float:
    if metric == "r2":
        return (chall - champ) / max(abs(champ), 1e-9)
    return (champ - chall) / max(abs(champ), 1e-9)


def select_champion(table: DataFrame, metric: str = "wape", threshold: float = CHALLENGER_THRESHOLD) -> Selection:
    """Best and second best; ``promotable`` when the improvement exceeds the threshold."""
    r = ranked(table, metric)
    top = r.where(F.col("rank") <= 2).orderBy("rank").select("model", metric).collect()
    champ = top[0]["model"]
    chall = top[1]["model"] if len(top) > 1 else None
    promotable = False
    if chall is not None and top[0][metric] is not None and top[1][metric] is not None:
        promotable = improvement(top[0][metric], top[1][metric], metric) > threshold
    return Selection(champ, chall, r, metric, promotable)


def selection_frame(table: DataFrame, metric: str = "wape", threshold: float = CHALLENGER_THRESHOLD) -> DataFrame:
    """L12 as a one-row DataFrame (champion, challenger, scores, promotable)."""
    r = ranked(table, metric)
    champ = F.max(F.when(F.col("rank") == 1, F.col("model")))
    chall = F.max(F.when(F.col("rank") == 2, F.col("model")))
    c1 = F.max(F.when(F.col("rank") == 1, F.col(metric)))
    c2 = F.max(F.when(F.col("rank") == 2, F.col(metric)))
    imp = (c2 - c1) / F.greatest(F.abs(c1), F.lit(1e-9)) if metric == "r2" else \
        (c1 - c2) / F.greatest(F.abs(c1), F.lit(1e-9))
    return r.agg(champ.alias("champion"), chall.alias("challenger"), c1.alias("champion_score"),
                 c2.alias("challenger_score"),
                 F.coalesce(imp > threshold, F.lit(False)).alias("challenger_promotable"))


def promotion_gate(scored: DataFrame, incumbent_col: str, candidate_col: str, y: str = TARGET,
                   threshold: float = CHALLENGER_THRESHOLD) -> DataFrame:
    """Incumbent vs candidate WAPE on the SAME rows; promote when the
    relative improvement exceeds the threshold."""
    inc = metric_exprs(y, incumbent_col)["wape"]
    cand = metric_exprs(y, candidate_col)["wape"]
    s = scored.agg(F.count(F.lit(1)).alias("n"), inc.alias("incumbent_wape"), cand.alias("candidate_wape"))
    imp = (F.col("incumbent_wape") - F.col("candidate_wape")) / F.greatest(F.abs(F.col("incumbent_wape")), F.lit(1e-9))
    return s.select("n", F.round("incumbent_wape", 6).alias("incumbent_wape"),
                    F.round("candidate_wape", 6).alias("candidate_wape"),
                    F.round(imp, 6).alias("improvement"),
                    F.coalesce(imp > threshold, F.lit(False)).alias("promote"))



def release_gate(scored: DataFrame, incumbent_col: str, candidate_col: str, y: str = TARGET, day: int = 15,
                 target: float = 0.04, threshold: float = CHALLENGER_THRESHOLD) -> DataFrame:
    """L13, all conditions of a release: the candidate's WAPE at ``day`` is within the target (that of the primary checkpoint), it
    beats the baseline on the same rows, and its improvement exceeds the threshold."""
    at = F.col(SNAPSHOT_DAY) == day
    only = lambda c: F.when(at, F.col(c))
    gate = promotion_gate(scored, incumbent_col, candidate_col, y, threshold)
    by_day = scored.select(only(y).alias(y), only(candidate_col).alias("c")).where(F.col(y).isNotNull()).agg(metric_exprs(y, "c")["wape"].alias("w"))
    return gate.crossJoin(by_day).select(  # one row each
        "n", "incumbent_wape", "candidate_wape", "improvement", F.round("w", 6).alias("day_wape"),
        F.coalesce(F.col("w") <= target, F.lit(False)).alias("meets_day_target"),
        F.coalesce(F.col("candidate_wape") < F.col("incumbent_wape"), F.lit(False)).alias("beats_baseline"),
        (F.col("promote") & F.coalesce(F.col("w") <= target, F.lit(False))).alias("releasable"))
