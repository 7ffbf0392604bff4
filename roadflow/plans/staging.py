"""Staging: trimmed text, canonical labels and the peak rank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.functions.labels import blank_to_null, canonical_label, label_rank

EVENT_TEXT = [
    "event_id",
    "area",
    "road_segment_id",
    "road_name",
    "weather",
    "incident_type",
    "day_of_week",
    "data_source",
    "anomaly_type",
]
METRIC_TEXT = ["area", "road_segment_id", "road_name"]


def stage_events(raw: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Raw events without the ISO text of the event time, every text trimmed, blanks NULL."""
    tidy = {c: blank_to_null(c) for c in EVENT_TEXT}
    tidy["congestion_level"] = canonical_label("congestion_level", aliases=aliases)
    return raw.drop("event_timestamp").withColumns(tidy)


def stage_metrics(metrics: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Window metrics with tidy text, the peak rank, and the count under its warehouse name."""
    if "event_count" in metrics.columns:
        metrics = metrics.withColumnRenamed("event_count", "total_events")
    level = "peak_congestion_level"
    tidy = {c: blank_to_null(c) for c in METRIC_TEXT}
    tidy["peak_congestion_rank"] = label_rank(level, aliases=aliases)
    tidy[level] = canonical_label(level, aliases=aliases)
    averages = ["avg_vehicle_count", "avg_speed_kmph", "avg_occupancy_pct"]
    return metrics.withColumns(tidy).select(
        "window_start", "window_end", *METRIC_TEXT, "total_events", *averages, "peak_congestion_rank", F.col(level)
    )
