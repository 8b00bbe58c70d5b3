"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_greatest(a: Column | str, b: Column | str) -> Column:
    """The larger value, NULL when either is NULL (``greatest`` alone skips NULL)."""
    a, b = _col(a), _col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; NULL for a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def ratio_or_one(numerator: Column | str, denominator: Column | str, above: float = 0.0) -> Column:
    """Division where the denominator exceeds ``above``, else 1; NULL denominators stay NULL."""
    bottom = _col(denominator)
    return F.when(bottom > above, ratio(numerator, bottom)).when(bottom.isNotNull(), F.lit(1.0))


def not_in(c: Column | str, values: Sequence[str]) -> Column:
    """Rows outside ``values``; NULL counts as outside."""
    c = _col(c)
    return c.isNull() | ~c.isin(list(values))


def month_start(c: Column | str) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def day_number(c: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(_col(c)))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def is_nonfinite(c: Column | str) -> Column:
    """NULL, NaN or infinite."""
    value = _col(c).cast("double")
    return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
