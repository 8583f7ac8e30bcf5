"""Scalar column functions.

Each mirrors one warehouse function whose rounding, NULL or day-boundary rule
differs from the obvious Spark call; everything stays inside codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def bool_flag(value: Column) -> Column:
    """1 for TRUE, 0 for FALSE and NULL."""
    return F.coalesce(value, F.lit(False)).cast("int")


def yes_no(value: Column) -> Column:
    """Yes/No or true/false text to boolean; anything else is NULL."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin("yes", "true"), True).when(text.isin("no", "false"), False)


def money(value: Column) -> Column:
    """Dollar text to an exact decimal."""
    return F.replace(value, F.lit("$"), F.lit("")).cast("decimal(38,9)")


def hour_of(clock: Column) -> Column:
    return F.substring(clock, 1, 2).cast("int")


def minute_of(clock: Column) -> Column:
    return F.substring(clock, 4, 2).cast("int")


def event_time(year: Column, month: Column, day: Column, clock: Column) -> Column:
    """Zone-less timestamp from date parts and an ``HH:MM`` clock text."""
    return F.make_timestamp_ntz(year, month, day, hour_of(clock), minute_of(clock), F.lit(0))


def epoch(instant: Column) -> Column:
    """Whole seconds since 1970, read in the session zone (UTC)."""
    return F.unix_seconds(instant.cast("timestamp"))


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine code of a position on a circle of ``period`` steps."""
    angle = position / F.lit(period) * F.lit(2.0) * F.pi()
    return F.sin(angle), F.cos(angle)


def is_weekend(instant: Column) -> Column:
    """Sunday is day 1 and Saturday day 7."""
    return flag(F.dayofweek(instant).isin(1, 7))


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar-day boundaries crossed, not 24-hour periods."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def round_to_int(value: Column) -> Column:
    """Float to integer, nearest with halves away from zero (Spark's cast truncates)."""
    return F.round(value).cast("bigint")


def half_up(value: float) -> int:
    """`round_to_int` for a plan-time constant."""
    return int(math.copysign(math.floor(abs(value) + 0.5), value))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 where it is undefined."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def bucket100(row_id: Column) -> Column:
    """Sign-free remainder that deals rows into 100 buckets."""
    return F.abs(row_id % 100)
