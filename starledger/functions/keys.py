"""Column builders for smart keys, calendar and clock attributes, labels and
business ids (F2-F9).  All are built-in expressions, so they stay inside
whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """YYYYMMDD integer key of a date (or timestamp) column."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k) -> Column:
    """Inverse of F2."""
    k = _c(k)
    return F.make_date(F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, (k % 100).cast("int"))


def time_key(hour, minute) -> Column:
    """HHMM integer key."""
    return (_c(hour) * 100 + _c(minute)).cast("int")


def quarter_of(month) -> Column:
    """(m - 1) div 3 + 1."""
    return (F.floor((_c(month) - 1) / 3) + 1).cast("int")


def is_weekend(d, weekend_days=(6, 7)) -> Column:
    """weekend flag; ``dayofweek`` is 1=Sunday..7=Saturday, so (6, 7) is a
    Friday/Saturday weekend.  The weekend set is a parameter."""
    return F.dayofweek(_c(d)).isin(*weekend_days).cast("int")


def time_bucket(hour) -> Column:
    """five-range clock bucket (fixed boundaries)."""
    h = _c(hour)
    return (F.when(h.between(5, 11), F.lit("Morning"))
            .when(h.between(12, 16), F.lit("Afternoon"))
            .when(h.between(17, 20), F.lit("Evening"))
            .otherwise(F.lit("Night")))


def is_daytime(hour) -> Column:
    """daytime flag for hours 06..18."""
    return _c(hour).between(6, 18).cast("int")


def hour_label(hour, minute) -> Column:
    """12-hour label ``HH:MM AM``/``PM``."""
    h, m = _c(hour), _c(minute)
    h12 = F.pmod(h + 11, F.lit(12)) + 1
    return F.concat(F.lpad(h12.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"),
                    F.when(h < 12, F.lit(" AM")).otherwise(F.lit(" PM")))


def padded_id(prefix: str, n, width: int) -> Column:
    """F8: ``prefix`` + zero-padded number (TXN+10, ACC+8, MER+6).  A number
    longer than ``width`` keeps all its digits, so ids stay distinct."""
    digits = _c(n).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def batch_id_label(lo, hi) -> Column:
    """F8: ``b_<lo:09d>_<hi:09d>`` batch id of an offset range."""
    return F.format_string("b_%09d_%09d", _c(lo), _c(hi))


def month_name(d) -> Column:
    """full English month name."""
    return F.date_format(_c(d), "MMMM")


def month_label(d) -> Column:
    """``MMM yyyy`` label."""
    return F.date_format(_c(d), "MMM yyyy")


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def month_index(d) -> Column:
    """Dense month number (year*12 + month - 1): gap-safe month arithmetic."""
    d = _c(d)
    return (F.year(d) * 12 + F.month(d) - 1).cast("int")


def month_key(date_key_col) -> Column:
    """YYYYMM of a YYYYMMDD key (integral division, stays an int)."""
    return F.call_function("div", _c(date_key_col), F.lit(100)).cast("int")
