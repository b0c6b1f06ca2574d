"""Calendar expressions for month-to-date snapshots."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from closecast.functions.columns import no_negative_zero


def month_label(month_start: Column) -> Column:
    return F.date_format(month_start, "yyyy-MM")


def date_label(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def days_in_month(month_start: Column) -> Column:
    return F.dayofmonth(F.last_day(month_start))


def business_days_through(month_start: Column, day: Column) -> Column:
    """Mon-Fri count from the 1st of the month through ``day`` (no holidays).

    Closed form: 5 per full week, plus the weekdays of the partial week that
    starts on the month's first weekday ``w0`` (0 = Monday).
    """
    w0 = F.weekday(month_start)
    rem = day % 7
    weekend_in_rem = ((12 - w0) % 7 < rem).cast("int") + ((13 - w0) % 7 < rem).cast("int")
    return (F.floor(day / 7) * 5 + rem - weekend_in_rem).cast("double")


def seasonal_sin(month: Column) -> Column:
    return no_negative_zero(F.round(F.sin(F.lit(2 * math.pi) * (month - 1) / 12), 6))


def seasonal_cos(month: Column) -> Column:
    return no_negative_zero(F.round(F.cos(F.lit(2 * math.pi) * (month - 1) / 12), 6))
