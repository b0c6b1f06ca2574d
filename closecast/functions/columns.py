"""Null / NaN / infinity hygiene and safe arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c: str | Column) -> Column:
    """NaN and +-Inf become NULL (ingest rule); NULL stays NULL."""
    x = col_of(c)
    return F.when(F.isnan(x) | (x == F.lit(_INF)) | (x == F.lit(-_INF)), F.lit(None)).otherwise(x)


def no_negative_zero(c: Column) -> Column:
    """Map -0.0 to 0.0 so equal values hash and print the same."""
    return F.when(c == 0, F.lit(0.0)).otherwise(c)
