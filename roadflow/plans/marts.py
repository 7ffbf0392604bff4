"""Star schema: date, segment, weather and incident dimensions; event and window facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.functions.labels import blank_to_null, surrogate_key
from roadflow.functions.times import date_key, is_weekend, iso_weekday
from roadflow.operators.dedup import keep_latest


def latest_events(staged: DataFrame) -> DataFrame:
    """Newest record of each event."""
    return keep_latest(staged)


def dim_date(events: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Days seen in the events or the window metrics, with their calendar attributes."""
    days = events.select(F.to_date("event_ts").alias("date_day"))
    if metrics is not None:
        days = days.unionByName(metrics.select(F.to_date("window_start").alias("date_day")))
    day = F.col("date_day")
    return (
        days.dropna()
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.monthname(day).alias("month_name"),
            F.dayofmonth(day).alias("day_of_month"),
            iso_weekday(day).alias("day_of_week"),
            F.dayname(day).alias("day_name"),
            is_weekend(day).alias("is_weekend"),
        )
    )


def label_dimension(events: DataFrame, label: str, key: str) -> DataFrame:
    """Distinct labels under the md5 of their lower-case form; spellings that differ in case share a key."""
    present = events.filter(blank_to_null(label).isNotNull())
    return present.select(surrogate_key(label).alias(key), F.trim(label).alias(label)).distinct()


def dim_weather(events: DataFrame) -> DataFrame:
    return label_dimension(events, "weather", "weather_key")


def dim_incident(events: DataFrame) -> DataFrame:
    return label_dimension(events, "incident_type", "incident_key")


def dim_road_segment(events: DataFrame) -> DataFrame:
    """Latest attributes of each segment."""
    columns = ["road_segment_id", "area", "road_name", "latitude", "longitude"]
    newest = ["generated_at", "event_ts"]
    return keep_latest(events.select(*columns, *newest), ["road_segment_id"], newest).select(*columns)


def fact_events(events: DataFrame) -> DataFrame:
    """Event grain with its dimension keys; NULL labels give NULL keys."""
    return events.select(
        "event_id",
        date_key(F.to_date("event_ts")).alias("date_key"),
        "road_segment_id",
        surrogate_key("weather").alias("weather_key"),
        surrogate_key("incident_type").alias("incident_key"),
        "event_ts",
        "vehicle_count",
        "avg_speed_kmph",
        "occupancy_pct",
        "congestion_level",
        "incident_duration_minutes",
    )


def set_aside(staged: DataFrame) -> DataFrame:
    """Rows out of range with the fields at fault, by day."""
    return staged.select(date_key(F.to_date("event_ts")).alias("date_key"), *staged.columns)


def fact_5min(metrics: DataFrame) -> DataFrame:
    """Window grain with its date key."""
    return metrics.select(
        date_key(F.to_date("window_start")).alias("date_key"),
        "road_segment_id",
        "window_start",
        "window_end",
        "area",
        "road_name",
        "total_events",
        "avg_vehicle_count",
        "avg_speed_kmph",
        "avg_occupancy_pct",
        "peak_congestion_rank",
        "peak_congestion_level",
    )
