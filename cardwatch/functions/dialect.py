"""Column helpers that reproduce the source SQL dialect on Spark built-ins.

Everything here is a plain ``Column`` expression, so it stays inside
whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_DATE = _dt.date(1970, 1, 1)
_US_PER_DAY = 86_400_000_000


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: _dt.datetime | _dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal (a date means its midnight)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    elif isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def plus_days(c: str | Column, days: int | Column) -> Column:
    """Timestamp plus whole days, time of day kept (``ts + n`` in the dialect)."""
    n = days if isinstance(days, Column) else F.lit(int(days))
    return col_(c) + F.make_dt_interval(n.cast("int"))


def minus_days(c: str | Column, days: int = 1) -> Column:
    """``ts - n``: the time of day is kept (``date_sub`` would drop it)."""
    return col_(c) - F.make_dt_interval(F.lit(int(days)))


def plus_years(c: str | Column, years: int) -> Column:
    return col_(c) + F.make_ym_interval(F.lit(int(years)), F.lit(0))


def epoch_us(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz``, zone independent.

    ``unix_micros`` rejects NTZ and ``timestamp_diff`` goes through the session
    time zone, which shifts wall-clock values inside a DST gap; the date-part
    sum below does not.
    """
    c = col_(c)
    return (
        F.datediff(F.to_date(c), F.lit(_EPOCH_DATE)).cast("long") * _US_PER_DAY
        + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000
        + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    )


def from_epoch_us(c: str | Column) -> Column:
    """Inverse of :func:`epoch_us`, as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", col_(c), ts_lit(_dt.datetime(1970, 1, 1)))


def window_us(window: _dt.timedelta) -> int:
    return (window.days * 86_400 + window.seconds) * 1_000_000 + window.microseconds


def concat_nullable(*cols: str | Column, sep: str = " ") -> Column:
    """The dialect's ``a || ' ' || b``: NULL concatenates as the empty string.

    Spark's ``concat`` returns NULL and ``concat_ws`` drops the separator; the
    source keeps every separator (an unmatched client gives two spaces).
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(col_(c), F.lit("")))
    return F.concat(*parts)


def empty_as_null(c: str | Column) -> Column:
    """The dialect stores '' as NULL; apply on intake of text columns."""
    c = col_(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def differs_null_safe(a: str | Column, b: str | Column) -> Column:
    return ~col_(a).eqNullSafe(col_(b))


def is_true(c: Column) -> Column:
    """Three-valued to two-valued, as a CASE/WHERE branch sees it."""
    return F.coalesce(c, F.lit(False))
