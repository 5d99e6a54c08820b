"""Exact money arithmetic.

Driver money columns are doubles.  They are cast to ``decimal(12,2)`` before
any sum so totals are exact and independent of summation order; results are
rounded on decimals (half away from zero) and only then turned into doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def units(c) -> Column:
    """Quantities are whole numbers stored as double; a fraction is an error,
    never cut off."""
    c = F.col(c) if isinstance(c, str) else c
    whole = c.cast("int")
    return F.when(c.isNull() | (whole == c), whole).otherwise(F.raise_error(F.concat(F.lit("not a whole quantity: "), c.cast("string"))).cast("int"))


def out(c) -> Column:
    """Final exact decimal -> double for the result schema."""
    return c.cast("double")


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, scale)`` on exact decimals."""
    return F.round(num * 100 / F.nullif(den, F.lit(0)), scale).cast("double")


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(num / den, scale)`` on exact decimals; NULL when ``den`` is 0."""
    return F.round(num / F.nullif(den, F.lit(0)), scale).cast("double")
