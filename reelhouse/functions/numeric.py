"""Decimal arithmetic with the warehouse's rounding rules.

The warehouse computes in exact DECIMAL and rounds half away from zero.
A quotient keeps four more decimals than its dividend before any outer
ROUND (the division precision of the warehouse's SQL dialect); AVG over a
DECIMAL(p,s) or integer column keeps s+4 decimals, which is also what
Spark's ``avg`` on decimals does. Division by zero gives NULL.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str) -> Column:
    """Exact decimal literal (``F.lit(60.0)`` would be a double)."""
    return F.lit(Decimal(value))


def mysql_div(num, den, num_scale: int) -> Column:
    """``num / den`` rounded to ``num_scale + 4`` decimals, NULL when den = 0."""
    num, den = _c(num), _c(den)
    # decimal(20,s) / decimal(20,6) keeps 12 decimals in Spark, so the
    # rounding below is the one that counts.
    q = num.cast(f"decimal(20,{num_scale})") / F.nullif(den.cast("decimal(20,6)"), dec("0"))
    return F.round(q, num_scale + 4)


def mysql_avg(col, scale: int = 0) -> Column:
    """AVG with ``scale + 4`` decimals (exact, HALF_UP), as DECIMAL."""
    return F.avg(_c(col).cast(f"decimal(24,{scale})"))


def pct(part, whole, digits: int) -> Column:
    """ROUND(part * 100.0 / NULLIF(whole, 0), digits)."""
    return F.round(mysql_div(_c(part) * dec("100.0"), whole, 1), digits)


def safe_ratio(num, den, num_scale: int, digits: int) -> Column:
    return F.round(mysql_div(num, den, num_scale), digits)


def money_label(amount) -> Column:
    """'$1,234,568' - thousands separators after rounding half up to whole units
    (``format_number`` alone rounds half even)."""
    return F.concat(F.lit("$"), F.format_number(F.round(_c(amount), 0), 0))


def to_double(col) -> Column:
    return _c(col).cast("double")
