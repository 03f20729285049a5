"""Exact-decimal price arithmetic.

Prices are computed in DECIMAL and cast to DOUBLE only when stored, so the
result does not depend on binary floating-point ties (SURVEY Q1).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NICKEL = Decimal("0.05")
CEILING_THRESHOLD = Decimal("9.99")
AVG_DECIMALS = 12


def dec(value: str | int) -> Column:
    """A DECIMAL literal (a bare Python float would turn the expression into DOUBLE)."""
    return F.lit(Decimal(str(value)))


def to_numeric(c: Column, precision: int, scale: int) -> Column:
    """CAST(c AS numeric(p, s)); rounds half-up, errors on overflow (ANSI)."""
    return c.cast(f"decimal({precision},{scale})")


def pct_of(pct: Column, price: Column) -> Column:
    """CAST(pct AS numeric(5,4)) * CAST(price AS numeric(7,2)) -> decimal(13,6)."""
    return to_numeric(pct, 5, 4) * to_numeric(price, 7, 2)


def round_money(x: Column, scale: int = 2) -> Column:
    """ROUND(numeric, scale): half away from zero, like T-SQL on numerics."""
    return F.round(x, scale)


def ceil_to_nickel(x: Column, times: Column | None = None) -> Column:
    """0.05 * CEILING(x / 0.05 [* times]) written as 0.05 * CEIL(x * 20 [* times]).

    x has at most 6 decimals, so x / 0.05 equals x * 20 exactly.
    """
    steps = x * F.lit(20)
    if times is not None:
        steps = steps * times
    return dec(NICKEL) * F.ceil(steps)


def ceiling_price(u: Column) -> Column:
    """Above 9.99 (tested on the rounded value) round the unrounded u up to a nickel."""
    return F.when(round_money(u) > dec(CEILING_THRESHOLD), ceil_to_nickel(u)).otherwise(round_money(u))


def round_dynamic_scale(x: Column, length: Column, lo: int = -6, hi: int = 6) -> Column:
    """ROUND(x, length) with a per-row length.

    Spark's ``round`` needs a constant scale, so each possible integer length
    becomes one branch; ``length`` is truncated to an integer like T-SQL does.
    x carries ``hi`` decimals at most, so any length >= hi leaves it unchanged.
    """
    n = length.cast("int")
    expr = F.when(n >= hi, x)
    for k in range(lo, hi):
        expr = expr.when(n == k, F.round(x, k))
    return expr.otherwise(F.round(x, lo))


def scaled_int_price(c: Column) -> Column:
    """BPUPRC * .0001: integer price in ten-thousandths -> exact decimal."""
    return c.cast("decimal(18,0)") * dec("0.0001")


def exact(c: Column, data_type: T.DataType) -> Column:
    """A price as the decimal that is summed."""
    return c if isinstance(data_type, T.DecimalType) else c.cast(f"decimal(28,{AVG_DECIMALS})")


def exact_avg(c: Column, data_type: T.DataType) -> Column:
    """AVG as exact decimal sum / count, divided once in DOUBLE.

    A double ``avg`` depends on summation order; a decimal sum does not. Decimal
    values are summed as they are stored; doubles at ``AVG_DECIMALS`` decimals,
    below the precision of a double price.
    """
    n = F.count(c)
    return F.when(n > 0, F.sum(exact(c, data_type)).cast("double") / n)

