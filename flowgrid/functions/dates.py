"""Date wrappers whose meaning differs from the Spark built-in of the same name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = {"microsecond", "millisecond", "second", "minute", "hour", "day", "week", "month",
          "quarter", "year"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_trunc_ntz(part: str, c) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (the built-in returns a zoned
    timestamp)."""
    return F.date_trunc(part, _c(c)).cast("timestamp_ntz")


_MICROS_PER = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def _epoch_micros(x: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (no zone rules)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), x)


def _monday(x: Column) -> Column:
    d = F.to_date(x)
    return F.date_sub(d, F.pmod(F.dayofweek(d) + F.lit(5), F.lit(7)))  # dayofweek: 1 = Sunday


def datediff_boundaries(a, b, part: str) -> Column:
    """Number of ``part`` boundaries crossed from ``a`` to ``b`` (the macro
    semantics; bare ``timestampdiff`` counts whole units instead).  Plain
    calendar arithmetic on the fields of the TIMESTAMP_NTZ values (floor
    division of epoch microseconds below a day), so no time-zone rule is
    consulted per row.  Weeks start on Monday.  Returns BIGINT."""
    part = part.lower()
    if part not in _PARTS:
        raise ValueError(f"unsupported date part {part!r}")
    ac, bc = _c(a).cast("timestamp_ntz"), _c(b).cast("timestamp_ntz")
    if part == "microsecond":
        out = F.timestamp_diff("MICROSECOND", ac, bc)
    elif part in _MICROS_PER:
        u = F.lit(_MICROS_PER[part])
        out = F.floor(_epoch_micros(bc) / u) - F.floor(_epoch_micros(ac) / u)
    elif part == "day":
        out = F.datediff(F.to_date(bc), F.to_date(ac))
    elif part == "week":
        out = F.datediff(_monday(bc), _monday(ac)) / F.lit(7)
    elif part == "month":
        out = (F.year(bc) - F.year(ac)) * 12 + (F.month(bc) - F.month(ac))
    elif part == "quarter":
        out = (F.year(bc) - F.year(ac)) * 4 + (F.quarter(bc) - F.quarter(ac))
    else:  # year
        out = F.year(bc) - F.year(ac)
    return out.cast("long")


def dateadd(part: str, n, c) -> Column:
    """``timestampadd`` (month ends clamp)."""
    q = F.lit(n) if isinstance(n, int) else _c(n)
    return F.timestamp_add(part.upper(), q, _c(c).cast("timestamp_ntz"))


def last_day_of(part: str, c) -> Column:
    """Last day (DATE) of the month / quarter / year containing ``c``."""
    part = part.lower()
    step = {"month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}[part]
    start = date_trunc_ntz(part, _c(c))
    return F.to_date(F.timestamp_add("DAY", F.lit(-1), F.timestamp_add(step, F.lit(1), start)))


def weekday_sunday0(c) -> Column:
    """Postgres/DuckDB ``dow``: 0 = Sunday."""
    return F.dayofweek(_c(c)) - 1


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime / date / string, independent of
    the session and process time zones (a bare ``F.lit(datetime)`` is a zoned
    timestamp built with the Python process's local zone)."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")
