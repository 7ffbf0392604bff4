"""Column helpers for event times: parsing, flooring, formatting, calendar parts and keys.

The helpers avoid the session time zone: zoned text is read with its own offset, and wall-clock
values are TIMESTAMP_NTZ, so a job gives the same days on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadflow.functions.fixed import TIME_ZONE, UTC_OFFSET
from roadflow.functions.labels import as_column


def event_instant(c: Column | str, offset: str = UTC_OFFSET) -> Column:
    """ISO-8601 text as TIMESTAMP; text without an offset is read at ``offset``, bad text is NULL."""
    text = F.trim(as_column(c))
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.try_to_timestamp(F.when(zoned, text).otherwise(F.concat(text, F.lit(offset))))


def wall_clock(instant: Column | str, zone: str = TIME_ZONE) -> Column:
    """Local wall-clock time (TIMESTAMP_NTZ) of an instant."""
    naive = as_column(instant).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(zone), naive)


def local_event_time(c: Column | str, zone: str = TIME_ZONE, offset: str = UTC_OFFSET) -> Column:
    return wall_clock(event_instant(c, offset), zone)


def floor_time(ts: Column | str, minutes: int) -> Column:
    """Start of the ``minutes``-wide bucket of the day; keeps the type of ``ts``."""
    if 1440 % minutes:
        raise ValueError("bucket width must divide a day")
    ts = as_column(ts)
    past = (F.hour(ts) * 60 + F.minute(ts)) % minutes
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), past, F.date_part(F.lit("SECOND"), ts))


def floor_second(ts: Column | str) -> Column:
    ts = as_column(ts)
    fraction = F.date_part(F.lit("SECOND"), ts) - F.second(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def plus_millis(ts: Column | str, millis: Column) -> Column:
    seconds = (millis / F.lit(1000)).cast("decimal(18,6)")
    return as_column(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def plus_minutes(ts: Column | str, minutes: Column) -> Column:
    return as_column(ts) + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end, with millisecond precision."""
    return F.timestamp_diff("MILLISECOND", as_column(start), as_column(end)) / F.lit(1000.0)


def iso_seconds(ts: Column | str, offset: str = UTC_OFFSET) -> Column:
    return F.concat(F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))


def iso_millis(ts: Column | str, offset: str = UTC_OFFSET) -> Column:
    return F.concat(F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(offset))


def date_key(day: Column | str) -> Column:
    """Day as the integer yyyymmdd."""
    day = as_column(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def event_key(segment: Column | str, ts: Column | str) -> Column:
    """Deterministic event id: segment, underscore, compact local time."""
    return F.concat(as_column(segment), F.lit("_"), F.date_format(as_column(ts), "yyyyMMdd'T'HHmmss"))


def iso_weekday(day: Column | str) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(as_column(day)) + 1


def is_weekend(day: Column | str) -> Column:
    return F.weekday(as_column(day)) >= 5


def day_name(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "EEEE")


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """Calendar parts stored with every event, and the partition texts of the event lake."""
    ts = as_column(ts)
    return {
        "is_weekend": is_weekend(ts),
        "hour_of_day": F.hour(ts),
        "day_of_week": day_name(ts),
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }
