"""Five-minute metrics per road segment, in batch and in a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.labels import label_rank, rank_label
from roadflow.functions.measures import mean
from roadflow.functions.times import floor_time

GRAIN = ("area", "road_segment_id", "road_name")


def window_metrics(
    events: DataFrame,
    grain: Sequence[str] = GRAIN,
    width: str = fixed.WINDOW,
    time: str = "event_ts",
    levels: Sequence[str] = fixed.RANKED_LEVELS,
    decimals: Mapping[str, int] | None = None,
    with_rank: bool = False,
) -> DataFrame:
    """Tumbling windows: event count, average count, speed and occupancy, and the peak congestion level.

    ``decimals`` maps a reading to its recorded decimals and makes that average exact. The default grain
    includes the road name, so readings without a name form their own row.
    """
    decimals = decimals or {}
    averages = {
        "avg_vehicle_count": "vehicle_count",
        "avg_speed_kmph": "avg_speed_kmph",
        "avg_occupancy_pct": "occupancy_pct",
    }
    grouped = (
        events.withColumn("_rank", exact_rank(levels))
        .groupBy(F.window(time, width).alias("_w"), *grain)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            *[mean(c, 2, decimals.get(c)).alias(name) for name, c in averages.items()],
            F.max("_rank").alias("peak_congestion_rank"),
        )
    )
    columns = [
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *grain,
        "event_count",
        *averages,
        *(["peak_congestion_rank"] if with_rank else []),
        rank_label("peak_congestion_rank", levels).alias("peak_congestion_level"),
    ]
    return grouped.select(*columns)


def exact_rank(levels: Sequence[str], column: str = "congestion_level"):
    """Rank of an already clean level; other spellings have no rank."""
    return F.when(F.col(column).isin(list(levels)), label_rank(column, levels))


def peak_level(events: DataFrame, keys: Sequence[str], levels: Sequence[str] = fixed.RANKED_LEVELS) -> DataFrame:
    """Highest congestion level per group."""
    rank = F.max(label_rank("congestion_level", levels))
    return (
        events.groupBy(*keys)
        .agg(rank.alias("peak_congestion_rank"))
        .withColumn("peak_congestion_level", rank_label("peak_congestion_rank", levels))
    )


def weather_timeline(
    events: DataFrame, time: str = "event_ts", labels: Sequence[str] = fixed.WEATHER
) -> DataFrame:
    """Area weather by minute: where readings disagree the most severe one holds."""
    return (
        events.groupBy("area", floor_time(time, 1).alias("minute"))
        .agg(F.max(label_rank("weather", labels)).alias("weather_rank"))
        .filter("weather_rank IS NOT NULL")
        .withColumn("area_weather", rank_label("weather_rank", labels))
    )


def spells_to_timeline(
    spells: DataFrame, start: str = "start_ts", end: str = "end_ts", labels: Sequence[str] = fixed.WEATHER
) -> DataFrame:
    """Overlapping weather spells [start, end) flattened to minutes; the most severe one holds."""
    last = F.col(end) - F.expr("INTERVAL 1 MICROSECOND")
    minutes = F.sequence(floor_time(start, 1), floor_time(last, 1), F.expr("INTERVAL 1 MINUTE"))
    return weather_timeline(
        spells.filter(F.col(start) < F.col(end)).withColumn("minute", F.explode(minutes)), "minute", labels
    )
