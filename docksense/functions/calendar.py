"""Time and calendar columns.

Wall times are ``TIMESTAMP_NTZ`` so that no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds to a UTC wall time."""
    return F.timestamp_add("SECOND", _col(seconds).cast("bigint"), F.expr(_EPOCH))


def from_epoch_millis(millis: Column | str) -> Column:
    return F.timestamp_add("MILLISECOND", _col(millis).cast("bigint"), F.expr(_EPOCH))


def to_epoch(ts: Column | str, unit: str = "SECOND") -> Column:
    """Whole units since the epoch of a wall time."""
    return F.timestamp_diff(unit, F.expr(_EPOCH), _col(ts))


def utc_to_local(ts: Column | str, zone: str = "Europe/Madrid") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def local_to_utc(ts: Column | str, zone: str = "Europe/Madrid") -> Column:
    """UTC wall time of a local one; of the hour that comes twice in autumn the first is taken."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(ts))


def floor_time(ts: Column | str, seconds: int) -> Column:
    """Start of the bucket of ``seconds`` that holds the wall time."""
    s = to_epoch(ts)
    return from_epoch(s - F.pmod(s, F.lit(seconds)))


def weekday(day: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.dayofweek(_col(day)) + 5) % 7 + 1


def workday(holiday: Column | str, weekday_col: Column | str) -> Column:
    """1 on Monday to Friday outside holidays, else 0."""
    free = (_col(holiday) == 0) & _col(weekday_col).between(1, 5)
    return F.when(free, 1).otherwise(0)


def hour_band(hour: Column | str) -> Column:
    h = _col(hour)
    return (
        F.when(h.between(0, 5), "night")
        .when(h.between(6, 9), "early_morning")
        .when(h.between(10, 14), "morning")
        .when(h.between(15, 19), "afternoon")
        .when(h.between(20, 23), "evening")
    )


def season(day: Column | str) -> Column:
    d = _col(day)
    md = F.month(d) * 100 + F.dayofmonth(d)
    return (
        F.when(md.between(321, 620), "Primavera")
        .when(md.between(621, 922), "Verano")
        .when(md.between(923, 1220), "Otoño")
        .when(md.isNotNull(), "Invierno")
    )


def ts_from_parts(y, m, d, h) -> Column:
    return F.make_timestamp_ntz(_col(y), _col(m), _col(d), _col(h), F.lit(0), F.lit(0))


def date_from_parts(y, m, d) -> Column:
    return F.make_date(_col(y), _col(m), _col(d))


def parse_iso(text: Column | str, fmt: str = "yyyy-MM-dd'T'HH:mm'Z'") -> Column:
    """ISO text to a wall time; text that does not fit gives null."""
    ntz = F.lit(fmt)
    return F.try_to_timestamp(_col(text), ntz).cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
