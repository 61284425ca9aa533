"""Numeric expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """num / den, NULL when either is NULL or den is 0."""
    ratio = F.try_divide(num.cast("double"), den.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def round_to_long(col: Column) -> Column:
    """Round half away from zero; a bare cast would truncate."""
    return F.round(col).cast("bigint")


def recovered_sessions(engaged: Column, rate: Column) -> Column:
    """Sessions = engaged / rate; unknown (NULL) when the rate is 0."""
    return round_to_long(safe_ratio(engaged, rate))


def null_as_zero_sum(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def signed_percent(value: Column, base: Column, digits: int | None = None) -> Column:
    """100 * (value - base) / base; NULL when there is no value or no base."""
    pct = F.try_divide(F.lit(100.0) * (value - base), base.cast("double"))
    return pct if digits is None else F.round(pct, digits)
