"""Joins of the star schema and of segment, area, incident and weather data.

No join carries a broadcast hint. Dimensions are read from written tables, so Spark knows their size and
broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``; above it the join is shuffled and a
skewed event side is split by adaptive execution.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.functions.congestion import incident_capacity, recovery_capacity, recovery_minutes
from roadflow.functions.labels import rank_label
from roadflow.functions.times import event_key, floor_time, is_weekend, micros_between
from roadflow.operators.sequences import episodes
from roadflow.operators.windows import weather_timeline


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest value of each other column: label dimensions may spell a key twice."""
    return dim.groupBy(key).agg(*[F.min(c).alias(c) for c in dim.columns if c != key])


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Left-join each dimension on its key column; facts with a NULL or unknown key are kept.

    Columns a dimension shares with the fact come out prefixed with the dimension's key.
    """
    out = fact
    for key, dim in dims.items():
        clash = [c for c in dim.columns if c != key and c in out.columns]
        out = out.join(dim.withColumnsRenamed({c: f"{key}_{c}" for c in clash}), key, "left")
    return out


def enrich(events: DataFrame, segments: DataFrame, columns: Sequence[str], key: str = "road_segment_id") -> DataFrame:
    """Segment attributes next to each event; NULL for an unknown segment."""
    return events.join(segments.select(key, *columns), key, "left")


def area_segment_count(areas: DataFrame, segments: DataFrame, key: str = "area_id") -> DataFrame:
    """Areas with the number of their segments (0 when there is none)."""
    counts = segments.groupBy(key).agg(F.count(F.lit(1)).alias("segments"))
    return areas.join(counts, key, "left").withColumn("segments", F.coalesce("segments", F.lit(0)).cast("long"))


def rows_in_set(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys found on one side only, with the side that has them. NULL keys are not orphans."""
    left = fact.select(key).dropna().distinct()
    right = dim.select(key).dropna().distinct()
    only_fact = left.join(right, key, "left_anti").withColumn("found_in", F.lit("fact"))
    only_dim = right.join(left, key, "left_anti").withColumn("found_in", F.lit("dimension"))
    return only_fact.unionByName(only_dim)


def incident_intervals(
    events: DataFrame,
    key: str = "road_segment_id",
    time: str = "event_ts",
    kind: str = "incident_type",
    minutes: str = "incident_duration_minutes",
    kinds: Sequence[str] = tuple(fixed.INCIDENTS[1:]),
) -> DataFrame:
    """One row per incident: every row of an incident carries its kind and its total duration.

    An incident is a run of consecutive rows of a segment with the same kind and duration; it starts with the first of
    them and lasts the duration from there on.
    """
    runs = episodes(events, [kind, minutes], key, time)
    found = runs.filter(F.col(kind).isin(list(kinds)) & (F.col(minutes) > 0))
    named = found.withColumn("incident_id", event_key(key, "start_ts")).drop("episode", "end_ts", "observations")
    return incident_windows(named)


def incident_windows(incidents: DataFrame, start: str = "start_ts") -> DataFrame:
    """Active end and recovery end of incidents given a start and ``incident_duration_minutes``."""
    seconds = F.col("incident_duration_minutes") * 60
    extra = F.round(recovery_minutes("incident_type", "incident_duration_minutes") * 60.0).cast("int")

    def after(s: Column) -> Column:
        return F.col(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s)

    return incidents.withColumn("end_ts", after(seconds)).withColumn("recovery_end_ts", after(seconds + extra))


def interval_width(intervals: DataFrame, start: str = "start_ts", end: str = "end_ts") -> int:
    """Seconds of a time bucket for these intervals: their mean length.

    An interval touches about 1 + length / width buckets, so with the mean as the width all intervals together are listed
    twice each on average, whether they last minutes or months. Reads the intervals once.
    """
    length = micros_between(start, end) / F.lit(1e6)
    mean = intervals.filter(F.col(start) < F.col(end)).agg(F.avg(length)).first()[0]
    return max(1, math.ceil(mean)) if mean is not None else 3600


def incident_matches(
    events: DataFrame,
    incidents: DataFrame,
    key: str = "road_segment_id",
    time: str = "event_ts",
    start: str = "start_ts",
    end: str = "recovery_end_ts",
    bucket_seconds: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Events within [start, end) of an incident on the same segment.

    Each incident is listed under every time bucket it touches, so the join has an equality on segment and
    bucket: a busy segment is spread over its buckets, and an event, which is in one bucket, meets only what touches
    it. The width comes from the incidents (``interval_width``) unless one is given; give written incidents, since they are
    read for it. Bucket columns are dropped.
    """
    width = bucket_seconds or interval_width(incidents, start, end)
    # The last instant within the interval is a microsecond before its end.
    touched = F.sequence(
        bucket_of(incidents, F.col(start), start, width),
        bucket_of(incidents, F.col(end) - F.expr("INTERVAL 1 MICROSECOND"), end, width),
    )
    spread = incidents.filter(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(touched)).alias("i")
    cut = events.withColumn("_bucket", bucket_of(events, F.col(time), time, width)).alias("e")
    on = (
        (F.col(f"e.{key}") == F.col(f"i.{key}"))
        & (F.col("e._bucket") == F.col("i._bucket"))
        & (F.col(f"e.{time}") >= F.col(f"i.{start}"))
        & (F.col(f"e.{time}") < F.col(f"i.{end}"))
    )
    kept = [F.col(f"i.{c}") for c in incidents.columns if c not in events.columns]
    return cut.join(spread, on, how).select(*[F.col(f"e.{c}") for c in events.columns], *kept)


def bucket_of(df: DataFrame, value: Column, column: str, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket that a time of ``column``'s type lies in, counted from 1970.

    Instants are counted as they are, wall-clock times by date and time of day, so both grow with time in every session zone.
    """
    if df.schema[column].dataType == T.TimestampNTZType():
        days = F.datediff(F.to_date(value), F.lit("1970-01-01").cast("date")).cast("long")
        whole = days * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    else:
        whole = F.unix_seconds(value)
    return F.floor(whole / F.lit(seconds))


def incident_phase(matches: DataFrame, kind: str = "active_incident", time: str = "event_ts") -> DataFrame:
    """Phase of a matched event, and its capacity factor: the incident's while it is active, then a ramp."""
    active = F.col(time) < F.col("end_ts")
    factor = incident_capacity(kind)
    ramp = recovery_capacity(
        factor, micros_between("end_ts", time) / F.lit(1e6), micros_between("end_ts", "recovery_end_ts") / F.lit(1e6)
    )
    return matches.withColumn("phase", F.when(active, "active").otherwise("recovery")).withColumn(
        "capacity_factor", F.when(active, factor).otherwise(ramp)
    )


def least_capacity(
    events: DataFrame, incidents: DataFrame, key: str = "event_id", kind: str = "active_incident"
) -> DataFrame:
    """Per event that an incident or its recovery covers: how many do, and the least capacity factor they leave."""
    matches = incident_phase(incident_matches(events, incidents), kind)
    return matches.groupBy(key).agg(
        F.count(F.lit(1)).alias("incidents"), F.min("capacity_factor").alias("capacity_factor")
    )


def area_minute_weather(events: DataFrame, time: str = "event_ts", labels: Sequence[str] = fixed.WEATHER) -> DataFrame:
    """Each event with the weather that holds in its area at its minute."""
    grid = weather_timeline(events, time, labels).select("area", F.col("minute").alias("_minute"), "weather_rank")
    keyed = events.withColumn("_minute", floor_time(time, 1))
    return (
        keyed.join(grid, ["area", "_minute"], "left")
        .drop("_minute")
        .withColumn("area_weather", rank_label("weather_rank", labels))
    )


def day_kind(time: Column | str) -> Column:
    return F.when(is_weekend(time), "weekend").otherwise("weekday")


def profile_value(hourly: Column, time: Column | str) -> Column:
    """Value of a 24-hour profile at a time of day: points sit at half past, straight lines between them,
    and the last point of the day leads into the first."""
    time = F.col(time) if isinstance(time, str) else time
    position = (F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)) / F.lit(3600.0) - 0.5
    low = F.floor(position)
    left = F.element_at(hourly, (F.pmod(low, F.lit(24)) + 1).cast("int"))
    right = F.element_at(hourly, (F.pmod(low + 1, F.lit(24)) + 1).cast("int"))
    return left + (right - left) * (position - low)


def with_profile(events: DataFrame, area_profiles: DataFrame, time: str = "event_ts") -> DataFrame:
    """Profile value at each event's time; ``area_profiles`` has area, day_kind, hourly and area factors."""
    return (
        events.withColumn("day_kind", day_kind(time))
        .join(area_profiles, ["area", "day_kind"], "left")
        .withColumn("profile", profile_value(F.col("hourly"), time))
        .drop("hourly")
    )
