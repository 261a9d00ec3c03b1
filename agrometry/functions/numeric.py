"""Exact means and totals, rounded half-up, once.

Floating-point sums depend on the order in which partitions arrive, so the
same table can round to two different values on two runs.  Sums therefore add
thousandths and what is left of them in 64-bit integers, which is exact,
independent of partitioning, and as cheap as double sums inside whole-stage
codegen.  Each value counts with the decimals that a double shows: twelve under
a thousand, nine under a million, six under a billion.  Larger values, where
the integers could overflow, are added as doubles; no value is cut off or left
out.  A mean is rounded from the exact quotient, by whole-number division.
Values that are not finite count as missing.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values from here on are added as doubles.
LARGE = 1e9
# The integers count thousandths, and 10**-12 within a thousandth.
_THOUSANDTHS, _UNITS = 1_000, 1_000_000_000


def finite(value: Column) -> Column:
    """The value as a double; NaN and Inf give NULL."""
    number = value.cast("double")
    return F.when(F.abs(number) <= F.lit(sys.float_info.max), number)


def _sum(value: Column) -> tuple[Column, Column, Column]:
    """The exact sum of a group: thousandths, and units of 10**-12 beside them; and the sum of its large values (NULL without any)."""
    number = finite(value)
    size = F.abs(number)
    scaled = F.when(size < LARGE, number) * float(_THOUSANDTHS)
    whole = F.floor(scaled)
    # more digits than a double holds would turn 0.3 into 0.29999999999
    step = F.when(size < 1e3, 1.0).when(size < 1e6, 1e3).otherwise(1e6)
    rest = (F.rint((scaled - whole) * (float(_UNITS) / step)) * step).cast("bigint")
    return F.sum(whole), F.sum(rest), F.sum(F.when(size >= LARGE, number))


def rounded(value: Column, places: int = 1) -> Column:
    """Half-up rounding of the decimals that a double shows."""
    return F.round(value.cast("double"), places)


def _div(value: Column, by: Column | int) -> Column:
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by).cast("bigint"))


def _quotient(whole: Column, rest: Column, count: Column, places: int) -> Column:
    """The sum divided by a count, rounded half-up (away from zero) in 64-bit integers.

    ``steps`` thousandths make one of the last place.  What the division leaves is at least half a step if twice it, with
    the whole parts of twice the fraction of a thousandth, is a step; the fraction pulls a negative sum towards zero.
    Places beyond the second, whose step is no longer many thousandths, take decimals, several times slower.
    """
    if places > 2:
        return _fine_quotient(whole, rest, count, places)
    thousandths = whole + _div(rest, _UNITS)
    twice = (rest % F.lit(_UNITS).cast("bigint")) * 2
    step = count * F.lit(_THOUSANDTHS // 10**places).cast("bigint")
    left = (thousandths % step) * 2
    up = F.when(left + _div(twice, _UNITS) >= step, F.lit(1)).when(left + _div(twice + (_UNITS - 1), _UNITS) <= -step, F.lit(-1)).otherwise(F.lit(0))
    return (_div(thousandths, step) + up) / F.lit(float(10**places))


def _exact(whole: Column, rest: Column) -> Column:
    return (whole.cast("decimal(38,0)") * F.lit(_UNITS) + rest).cast("decimal(38,0)")


def _fine_quotient(whole: Column, rest: Column, count: Column, places: int) -> Column:
    units, one = _exact(whole, rest), F.lit(_THOUSANDTHS * _UNITS).cast("decimal(13,0)")
    twice = F.abs(units) * F.lit(2 * 10**places) + count.cast("decimal(20,0)") * one
    steps = _div(twice.cast("decimal(38,0)"), (count.cast("decimal(20,0)") * one * 2).cast("decimal(38,0)"))
    return F.when(units < 0, -steps).otherwise(steps) / F.lit(float(10**places))


def _joined(sums: tuple[Column, Column, Column], exactly: Column, places: int, count: Column | None = None) -> Column:
    """The exact result, or, in a group with large values, that of the sum of doubles."""
    whole, rest, large = sums
    plain = F.coalesce(_exact(whole, rest).cast("double") / float(_THOUSANDTHS * _UNITS), F.lit(0.0)) + large
    plain = plain if count is None else plain / count
    return F.when(large.isNull(), exactly).otherwise(rounded(plain, places))


def mean(value: Column, places: int = 1) -> Column:
    sums = _sum(value)
    count = F.count(finite(value))
    return _joined(sums, F.when(count > 0, _quotient(*sums[:2], count, places)), places, count)


def total(value: Column, places: int = 1) -> Column:
    sums = _sum(value)
    return _joined(sums, _quotient(*sums[:2], F.lit(1).cast("bigint"), places), places)


def lowest(value: Column, places: int = 1) -> Column:
    return rounded(F.min(finite(value)), places)


def highest(value: Column, places: int = 1) -> Column:
    return rounded(F.max(finite(value)), places)


def as_double(value: Column) -> Column:
    return value.cast("double")


def as_numeric(value: Column) -> Column:
    """The type of a one-decimal warehouse measure, whatever its size."""
    return value.cast("decimal(38,1)")


def first_below(value: Column, limits, other) -> Column:
    """Label of the first limit the value lies under; NULL takes ``other``."""
    (limit, label), *rest = limits
    steps = F.when(value < limit, F.lit(label))
    for limit, label in rest:
        steps = steps.when(value < limit, F.lit(label))
    return steps.otherwise(F.lit(other))
