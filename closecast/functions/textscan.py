"""Secret / contact-data detection and redaction on text columns.

Built-in regex expressions (``rlike`` / ``regexp_replace``) only; every row is
scanned whole and each pattern runs once per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: patterns in declared (application) order, with their finding labels
SENSITIVE_PATTERNS: list[tuple[str, str]] = [
    ("azure_subscription_guid",
     r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
    ("connection_string", r"(?i)(AccountKey|SharedAccessKey|Password)=[^;\s]+"),
    ("bearer_token", r"Bearer\s+[A-Za-z0-9\-\._~\+\/]+=*"),
    ("sas_token", r"(?i)[?&]sig=[^&\s]+"),
    ("email", r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"),
    ("us_phone", r"\b\(?\d{3}\)?[\s.\-]\d{3}[\s.\-]\d{4}\b"),
]
REDACTED = "[REDACTED]"


def contains_secret(text: Column) -> Column:
    """True if any pattern matches (NULL text -> false)."""
    hit = F.lit(False)
    for _, pat in SENSITIVE_PATTERNS:
        hit = hit | F.coalesce(text.rlike(pat), F.lit(False))
    return hit


def redact(text: Column, replacement: str = REDACTED) -> Column:
    """Y2: replace every match, patterns applied in declared order."""
    out = text
    for _, pat in SENSITIVE_PATTERNS:
        out = F.regexp_replace(out, pat, replacement)
    return out


def findings(text: Column) -> Column:
    """Names of matching patterns in declared order, comma-joined ('' where none match)."""
    return F.concat_ws(",", *[F.when(text.rlike(pat), F.lit(name)) for name, pat in SENSITIVE_PATTERNS])


def with_findings(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` rows with at least one finding, in a column ``findings`` instead of the text.

    The one-element explode keeps the filter from being pushed below the
    projection, which would evaluate every pattern a second time.
    """
    found = df.select(*[c for c in df.columns if c != text_col], F.explode(F.array(findings(F.col(text_col)))).alias("findings"))
    return found.where(F.col("findings") != "")


def scan_corpus(sources: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Scan several text tables; one row per text with at least one finding.

    ``sources`` = [(source name, frame, id column, text column)].
    """
    parts = []
    for name, df, id_col, text_col in sources:
        named = df.select(F.lit(name).alias("source"), F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("t"))
        parts.append(with_findings(named, "t"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan_verdict(found: DataFrame, allow_sources: list[str] | None = None, allow_items: list[tuple[str, str]] | None = None) -> DataFrame:
    """Y4 verdict, one row: n_allowed, n_violations, passed.

    Findings in allowed sources or allowed (source, item_id) pairs (lists from
    configuration) are counted apart and do not fail the scan.
    """
    allowed = F.col("source").isin(list(allow_sources)) if allow_sources else F.lit(False)
    for source, item in allow_items or []:
        allowed = allowed | ((F.col("source") == source) & (F.col("item_id") == item))
    return found.agg(F.count_if(allowed).alias("n_allowed"), F.count_if(~allowed).alias("n_violations")).select(
        "n_allowed", "n_violations", (F.col("n_violations") == 0).alias("passed"))
