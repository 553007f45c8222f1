"""Calendar column helpers. All are built-in expressions (codegen, no UDF)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """YYYYMMDD integer key of a date/timestamp (arithmetic, no string formatting)."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def ym_label(d) -> Column:
    """'YYYY-MM' label."""
    return F.date_format(_c(d), "yyyy-MM")


def day_name(d) -> Column:
    """Full English day name ('Monday'); Spark's ``dayname`` is abbreviated."""
    return F.date_format(_c(d), "EEEE")


def month_name(d) -> Column:
    """Full English month name ('January')."""
    return F.date_format(_c(d), "MMMM")


def mysql_week_monday(d) -> Column:
    """Week number with Monday as first day, 0..53, where week 1 is the first
    week with four or more days in the year (days before it are week 0).

    w = weekday of 1 January (Monday = 0); week = floor((doy-1+w)/7) plus one
    when 1 January falls Monday..Thursday."""
    d = _c(d)
    w = F.weekday(F.make_date(F.year(d), F.lit(1), F.lit(1)))
    base = F.floor((F.dayofyear(d) - 1 + w) / 7).cast("int")
    return (base + F.when(w <= 3, 1).otherwise(0)).cast("int")


def month_index(d) -> Column:
    """year*12 + month, for month arithmetic."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def months_between_starts(a, b) -> Column:
    """Whole months from the month of ``a`` to the month of ``b`` (both on month starts)."""
    return (month_index(b) - month_index(a)).cast("int")


def wall_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp,
    from its calendar parts only - no session time zone or DST rule enters."""
    ts = _c(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    sec = F.date_part(F.lit("SECOND"), ts)            # decimal(8,6), with fraction
    return (day * 86400000000 + F.hour(ts).cast("bigint") * 3600000000
            + F.minute(ts).cast("bigint") * 60000000 + (sec * 1000000).cast("bigint"))
