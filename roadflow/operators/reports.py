"""Dashboard measures and comparisons over cleaned events, the marts and the window metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.labels import label_rank
from roadflow.functions.measures import mean, rounded_ratio, scaled_sum
from roadflow.operators.quality import with_share


def exact_ratio(total: Column, n: Column, places: int = 4) -> Column:
    return F.round(total / n, places)


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def hourly_profile(events: DataFrame, decimals: int | None = None) -> DataFrame:
    """Average count and speed by hour of day."""
    return events.groupBy("hour_of_day").agg(
        mean("vehicle_count", 2, None if decimals is None else 0).alias("avg_vehicle_count"),
        mean("avg_speed_kmph", 2, decimals).alias("avg_speed_kmph"),
        F.count(F.lit(1)).alias("observations"),
    )


def _hours(hours: Sequence[int]) -> Column:
    return F.col("hour_of_day").isin(list(hours))


def peak_night_ratio(
    events: DataFrame,
    keys: Sequence[str],
    peak: Sequence[int] = (9, 10, 18, 19),
    night: Sequence[int] = (2, 3, 4),
    decimals: int | None = None,
) -> DataFrame:
    """Average count at peak hours against the night hours, and the average speed of both.

    ``decimals`` are those the speed is recorded with; without it readings are summed as they are.
    """
    busy = F.avg(F.when(_hours(peak), F.col("vehicle_count")))
    quiet = F.avg(F.when(_hours(night), F.col("vehicle_count")))
    return events.groupBy(*keys).agg(
        F.round(busy, 6).alias("peak_vehicles"),
        F.round(quiet, 6).alias("night_vehicles"),
        F.round(busy / F.nullif(quiet, F.lit(0.0)), 6).alias("peak_to_night"),
        mean(F.when(_hours(peak), F.col("avg_speed_kmph")), 2, decimals).alias("peak_speed"),
        mean(F.when(_hours(night), F.col("avg_speed_kmph")), 2, decimals).alias("night_speed"),
    )


def severe_share(
    events: DataFrame,
    keys: Sequence[str] = ("area",),
    hours: Sequence[int] | None = None,
    levels: Sequence[str] = ("High", "Severe"),
) -> DataFrame:
    """Share of events at the upper levels, over all hours or the given ones."""
    rows = events if hours is None else events.filter(_hours(hours))
    upper = F.col("congestion_level").isin(list(levels))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("observations"),
        F.round(F.avg(F.when(upper, 1).otherwise(0)), 6).alias("severe_share"),
    )


def weekday_weekend(events: DataFrame, areas: Sequence[str], hours: Sequence[int]) -> DataFrame:
    """Average count on weekdays and weekends, and their ratio, for some areas and hours."""
    rows = events.filter(F.col("area").isin(list(areas)) & _hours(hours))
    weekend = F.avg(F.when(F.col("is_weekend"), F.col("vehicle_count")))
    weekday = F.avg(F.when(~F.col("is_weekend"), F.col("vehicle_count")))
    return rows.groupBy("area").agg(
        F.round(weekday, 6).alias("weekday_vehicles"),
        F.round(weekend, 6).alias("weekend_vehicles"),
        F.round(weekday / F.nullif(weekend, F.lit(0.0)), 6).alias("weekday_to_weekend"),
    )


def occupancy_speed_correlation(events: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*keys).agg(F.round(F.corr("occupancy_pct", "avg_speed_kmph"), 6).alias("correlation"))


def day_over_day(events: DataFrame, key: str = "road_segment_id", time: str = "event_ts") -> DataFrame:
    """Daily vehicles per segment and the change from the segment's previous observed day."""
    daily = events.groupBy(key, F.to_date(time).alias("day")).agg(F.sum("vehicle_count").alias("vehicles"))
    before = F.lag("vehicles").over(Window.partitionBy(key).orderBy("day"))
    return daily.withColumn("previous_vehicles", before).withColumn(
        "change", F.col("vehicles") - F.col("previous_vehicles")
    )


def kpi_totals(fact_events: DataFrame, fact_5min: DataFrame, decimals: int | None = None) -> DataFrame:
    """Windows, vehicles, average speed and average occupancy as one row."""
    from_events = fact_events.agg(
        F.sum("vehicle_count").alias("total_vehicles"),
        mean("avg_speed_kmph", 2, decimals).alias("avg_speed_kmph"),
        mean("occupancy_pct", 2, decimals).alias("avg_occupancy_pct"),
    )
    windows = fact_5min.agg(F.count(F.lit(1)).alias("windows"))
    both = windows.unionByName(from_events, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("windows", "total_vehicles", "avg_speed_kmph", "avg_occupancy_pct")])


def congestion_split(windows: DataFrame, level: str = "peak_congestion_level") -> DataFrame:
    """Windows per level and their percentage."""
    shares = with_share(group_counts(windows, [level]), "n", "share", 10)
    return shares.select(level, "n", F.round(F.col("share") * 100, 2).alias("percent"))


def congestion_trend(windows: DataFrame, time: str = "window_start") -> DataFrame:
    """Average peak rank by area and hour."""
    return windows.groupBy("area", F.hour(time).alias("hour")).agg(
        mean("peak_congestion_rank", 4, 0).alias("avg_rank"), F.count(F.lit(1)).alias("windows")
    )


def area_rank(windows: DataFrame) -> DataFrame:
    """Average peak rank by area."""
    return windows.groupBy("area").agg(mean("peak_congestion_rank", 4, 0).alias("avg_rank"))


def area_volume(events: DataFrame) -> DataFrame:
    """Vehicles by area, most first."""
    volume = events.groupBy("area").agg(F.sum("vehicle_count").alias("vehicles"))
    return volume.orderBy(F.desc("vehicles"), "area")


def top_areas(events: DataFrame, k: int = 3) -> DataFrame:
    """The k areas with the most vehicles."""
    return area_volume(events).limit(k)


def event_frontier(events: DataFrame, keys: Sequence[str] = (), time: str = "event_ts") -> DataFrame:
    """Latest event time per group."""
    return events.groupBy(*keys).agg(F.max(time).alias("frontier"))


def condition_impact(events: DataFrame, condition: str, base: str, decimals: int | None = None) -> DataFrame:
    """Average speed and count per condition, and speed against the base condition.

    Sums are kept whole, so the base row is found among the groups without another pass over the events. ``decimals``
    are those the speed is recorded with, which makes its sum exact; without it readings are summed as they are.
    """
    total = F.sum("avg_speed_kmph") if decimals is None else scaled_sum("avg_speed_kmph", decimals)
    groups = events.groupBy(condition).agg(
        F.count("avg_speed_kmph").alias("observations"),
        total.alias("_speed"),
        F.sum("vehicle_count").alias("_vehicles"),
        F.count("vehicle_count").alias("_counts"),
    )
    speed = F.col("_speed") / F.col("observations")
    reference = groups.filter(F.col(condition) == base).agg(F.max(speed)).scalar()
    return groups.select(
        condition,
        "observations",
        (F.round(speed, 2) if decimals is None else rounded_ratio(F.col("_speed"), F.col("observations"), decimals)).alias(
            "avg_speed_kmph"
        ),
        rounded_ratio(F.col("_vehicles"), F.col("_counts"), 0).alias("avg_vehicle_count"),
        F.round(speed / reference, 4).alias("speed_vs_base"),
    )


def weather_impact(events: DataFrame, decimals: int | None = None) -> DataFrame:
    return condition_impact(events, "weather", fixed.WEATHER[0], decimals)


def incident_impact(events: DataFrame, decimals: int | None = None) -> DataFrame:
    return condition_impact(events, "incident_type", fixed.INCIDENTS[0], decimals)


def arrival_lag(events: DataFrame, keys: Sequence[str] = ("anomaly_type",)) -> DataFrame:
    """Smallest, largest and average seconds from event time to arrival."""
    millis = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("generated_at"))
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.min(millis) / F.lit(1000.0)).alias("min_seconds"),
        (F.max(millis) / F.lit(1000.0)).alias("max_seconds"),
        F.round(F.sum(millis) / F.count(millis) / F.lit(1000.0), 3).alias("avg_seconds"),
    )


def lag_sketches(events: DataFrame, keys: Sequence[str], size: int = 400) -> DataFrame:
    """A quantile sketch of the milliseconds from event time to arrival, per group; sketches of parts can be merged.

    The rank error of a sketch of ``size`` is about 1.3 / size ** 0.9, 0.6 % for 400, whatever the number of rows.
    """
    millis = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("generated_at"))
    return events.groupBy(*keys).agg(F.kll_sketch_agg_bigint(millis, F.lit(size)).alias("sketch"), F.count(millis).alias("n"))


def lag_quantiles(
    sketches: DataFrame, keys: Sequence[str] = ("anomaly_type", "area"), probabilities: Sequence[float] = (0.5, 0.9, 0.99)
) -> DataFrame:
    """Lag in milliseconds below which the given shares of the rows lie, from merged sketches; NULL for a group without lags."""
    merged = sketches.filter("n > 0").groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n").alias("n"))
    quantiles = [F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias(f"p{p * 100:g}".replace(".", "_")) for p in probabilities]
    found = merged.select(*keys, "n", *quantiles)
    empty = sketches.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n = 0")
    return found.unionByName(empty, allowMissingColumns=True)


def late_events(events: DataFrame, allowed_minutes: int = 10, keys: Sequence[str] = ("area",)) -> DataFrame:
    """Audit of the raw lake: events that arrived later than the watermark allows, per group.

    A stream drops an event once the newest event time seen is more than the allowed delay ahead; the
    arrival lag is the measure of that which is left in the stored rows.
    """
    lag = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("generated_at"))
    late = lag > allowed_minutes * 60_000
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(late, 1)).alias("late"),
        F.round(F.avg(F.when(late, 1).otherwise(0)), 6).alias("late_share"),
    )


def level_ranks(events: DataFrame, levels: Sequence[str] = fixed.RANKED_LEVELS) -> DataFrame:
    return events.withColumn("congestion_rank", label_rank("congestion_level", levels))
