"""Exact, order-free sums of amounts.

A plain DOUBLE sum depends on the order in which partitions arrive, so two runs over the same
table can differ. DECIMAL sums are exact, but a sum wider than 18 digits leaves the
64-bit fast path and costs about nine times as much. An amount is therefore split into its whole
number and its fraction in units of ``10 ** -DIGITS``, rounded half away from zero as DECIMAL does; the
two are summed as BIGINTs and joined once, at the end, in DECIMAL(38).

A BIGINT holds a total of 9.2e18 and the fractions of 9e12 rows, far beyond any table; under ANSI
arithmetic a sum beyond that would raise, never wrap. NaN, infinities and numbers that no BIGINT holds
are no measurements: they count as missing, and ``unmeasured`` tells how many there were.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGITS = 6
# Beyond this a whole number does not fit a BIGINT.
LIMIT = 9.2e18


def _column(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def measured(value: Column | str) -> Column:
    """The value, or NULL if it is no measurement. NaN compares as larger than any number."""
    col = _column(value)
    return F.when(F.abs(col) < F.lit(LIMIT), col)


def unmeasured(value: Column | str) -> Column:
    """Is there a value, but no measurement?"""
    col = _column(value)
    return col.isNotNull() & (F.abs(col) >= F.lit(LIMIT))


def whole_of(value: Column | str) -> Column:
    """The whole number of an amount, towards zero; NULL if it is no measurement."""
    col = measured(value)
    return (F.signum(col) * F.floor(F.abs(col)).cast("double")).cast("bigint")


def part_of(value: Column | str, digits: int = DIGITS) -> Column:
    """The rest of the amount in units of ``10 ** -digits``, rounded half away from zero."""
    col = measured(value)
    size = F.abs(col)
    rest = (size - F.floor(size).cast("double")) * F.lit(float(10**digits))
    return (F.signum(col) * F.floor(rest + 0.5).cast("double")).cast("bigint")


def sums(value: Column | str, digits: int = DIGITS) -> list[Column]:
    """The two sums of a measure, as ``units`` and ``parts``."""
    return [F.sum(whole_of(value)).alias("units"), F.sum(part_of(value, digits)).alias("parts")]


def amount_of(units: Column | str = "units", parts: Column | str = "parts", digits: int = DIGITS) -> Column:
    """The total of two sums as a DOUBLE; NULL if nothing was measured."""
    units = F.col(units) if isinstance(units, str) else units
    parts = F.col(parts) if isinstance(parts, str) else parts
    step = F.lit(f"1e-{digits}").cast(f"decimal({digits + 1},{digits})") if digits else F.lit(1).cast("decimal(1,0)")
    return (units.cast("decimal(20,0)") + parts.cast(f"decimal({31 - digits},0)") * step).cast("double")


def mean_of(count: Column | str, units: Column | str = "units", parts: Column | str = "parts", digits: int = DIGITS) -> Column:
    """Mean over the rows that have a measurement: NULL, not an error, when there are none."""
    count = F.col(count) if isinstance(count, str) else count
    return F.try_divide(amount_of(units, parts, digits), count.cast("double"))
