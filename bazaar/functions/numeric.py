"""Numeric helpers that pin the result types and rounding of the models.

The models were specified against an engine where ``/`` on integers and
decimals yields DOUBLE, ``avg(decimal)`` is a DOUBLE, money sums are
DECIMAL(38,2) and ``round(double, 2)`` is ``round-half-away(x * 100) / 100``
evaluated in binary floating point. Spark differs on each point (decimal
division, decimal averages, decimal-string rounding), so every model goes
through these helpers instead of the bare operators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM_TYPE = "decimal(38,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(x: Column | str) -> Column:
    """round(x, 2) for a DOUBLE: scale by 100, round half away from zero, unscale.

    Spark's ``round`` rounds the shortest decimal string of the double
    (1.005 -> 1.01); the binary product 1.005 * 100 is 100.49999999999999,
    which rounds to 100 (1.0). Rounding the scaled double to 0 places matches
    the binary behaviour exactly, because 0-place rounding of the shortest
    string agrees with the binary value's own rounding.
    """
    value = _col(x)
    rounded = F.round(value * F.lit(100.0), 0) / F.lit(100.0)
    # keep the sign of a zero result (-0.001 rounds to -0.0, not 0.0)
    return F.when(rounded == 0, value * F.lit(0.0)).otherwise(rounded)


def ratio_pct(numerator: Column, denominator: Column) -> Column:
    """round(100 * numerator / nullif(denominator, 0), 2) as DOUBLE; NULL on 0."""
    return round2(F.lit(100.0) * numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double"))


def money_sum(x: Column | str) -> Column:
    """sum of a DECIMAL(p,2) column as DECIMAL(38,2) (no precision growth)."""
    return F.sum(_col(x)).cast(MONEY_SUM_TYPE)


def decimal_avg(x: Column | str, scale: int = 2) -> Column:
    """avg of a DECIMAL(p,scale) column as DOUBLE.

    Computed as unscaled exact sum / (count * 10^scale) in one IEEE division,
    the nearest double to the exact mean, independent of row order.
    NULL inputs are skipped; NULL when no input.
    """
    c = _col(x)
    return decimal_mean(F.sum(c), F.count(c), scale)


def decimal_mean(total: Column, n: Column, scale: int = 2) -> Column:
    """Mean as DOUBLE from an exact DECIMAL total and a count; NULL for a count of 0."""
    factor = 10**scale
    unscaled = (total * F.lit(factor)).cast("double")
    return unscaled / F.nullif(n * F.lit(float(factor)), F.lit(0.0))


_SPLIT = float(2**32)


def double_sum(x: Column | str) -> Column:
    """sum of a DOUBLE column, exact up to the final rounding to double.

    A plain floating sum depends on row order, so it changes with the
    partitioning, and money sums often land on a half-cent tie where that
    noise flips the 2-dp rounding. Each value is split exactly into an
    integer number of 2^-32 units (summed as DECIMAL(38,0), no overflow) and a
    remainder below one unit (summed as double, error far below 2^-32).
    The result is the same for any partitioning.
    """
    units, rest = split_double(x)
    return double_total(F.sum(units), F.sum(rest))


def split_double(x: Column | str) -> tuple[Column, Column]:
    """A DOUBLE as whole 2^-32 units, DECIMAL(38,0), and what is left of it in such units."""
    scaled = _col(x) * F.lit(_SPLIT)  # exact: power-of-two scaling
    units = F.floor(scaled)  # BIGINT
    return units.cast("decimal(38,0)"), scaled - units.cast("double")  # exact


def double_total(units: Column, rest: Column) -> Column:
    """The DOUBLE of summed units and rests."""
    return (units.cast("double") + rest) / F.lit(_SPLIT)


def double_avg(x: Column | str) -> Column:
    """avg of a DOUBLE column: order-independent sum / count."""
    c = _col(x)
    return double_sum(c) / F.nullif(F.count(c), F.lit(0)).cast("double")


def count_where(predicate: Column) -> Column:
    """count(*) FILTER (WHERE predicate): a NULL predicate does not count."""
    return F.count_if(predicate)
