"""Order within a segment: gaps, inversions, episodes, missing observations, running shares.

A segment may hold a third of all rows, so no step below sorts a whole segment in one task. Rows are first
grouped to one per segment and time, which folds copies before the shuffle; neighbours are then found inside
(segment, day) chunks, and only the last row of each chunk is passed on along the segment. The part that is
ordered per segment has one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.functions.times import floor_time, micros_between


def present(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def with_previous(
    df: DataFrame,
    key: str,
    time: str,
    carried: Sequence[str],
    target: str = "previous",
    chunk: str = "DAY",
    day: str | None = None,
) -> DataFrame:
    """Add the struct of ``carried`` columns of the row before, by time, within the key.

    Needs one row per key and time; ``chunk`` is the stretch of time that one task sorts. Both branches below keep the same columns and the same NULL filter, so
    Spark reads one shuffle for both and scans the input once. ``day`` names a column that holds the local day already; rows
    that are stored by key and day are then not shuffled, but read for both branches.
    """
    part = day or "_chunk"
    if day is None:
        df = df.withColumn(part, F.date_trunc(chunk, time))
    df = df.filter(present(key, part))
    in_chunk = Window.partitionBy(key, part).orderBy(time)
    rows = df.withColumn("_before", F.lag(F.struct(*carried)).over(in_chunk))
    ends = df.groupBy(key, part).agg(F.max_by(F.struct(*df.columns), F.col(time)).alias("_end"))
    along = Window.partitionBy(key).orderBy(part)
    before = F.col("_before")
    carry = F.when(before.isNotNull(), F.struct(*[before[c].alias(c) for c in carried]))
    ends = ends.withColumn("_before", F.lag("_end").over(along)).select(key, part, carry.alias("_carry"))
    return (
        rows.join(ends, [key, part], "left")
        .withColumn(target, F.coalesce("_before", "_carry"))
        .drop(part, "_before", "_carry")
    )


def observation_gaps(
    events: DataFrame, key: str = "road_segment_id", time: str = "event_ts", day: str | None = None
) -> DataFrame:
    """One row per segment and observation time, with the time before it and the gap in seconds.

    ``day`` names a column that holds the day of the time, for tables that are stored by segment and day.
    """
    grain = [key, day, time] if day else [key, time]
    times = events.filter(present(key, time)).groupBy(*grain).agg(F.count(F.lit(1)).alias("observations"))
    gaps = with_previous(times, key, time, [time], day=day)
    return gaps.select(
        key,
        time,
        "observations",
        F.col(f"previous.{time}").alias("previous_ts"),
        (micros_between(F.col(f"previous.{time}"), time) / F.lit(1e6)).alias("gap_seconds"),
    )


def order_inversions(
    events: DataFrame, key: str = "road_segment_id", arrival: str = "generated_at", time: str = "event_ts"
) -> DataFrame:
    """Per segment: rows, and how often a row arrived after one with a later event time.

    Rows that arrive together count in event-time order, so a group of equal arrivals can only be out of
    order against the group before it.
    """
    arrivals = (
        events.filter(present(key, arrival, time))
        .groupBy(key, arrival)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
    )
    # Arrivals have milliseconds, so a day of a busy segment holds too many of them for one task.
    steps = with_previous(arrivals, key, arrival, ["last_ts"], chunk="HOUR")
    late = F.when(F.col("first_ts") < F.col("previous.last_ts"), 1)
    return steps.groupBy(key).agg(F.sum("rows").alias("observations"), F.count(late).alias("inversions"))


def episodes(
    events: DataFrame,
    labels: Sequence[str],
    key: str = "road_segment_id",
    time: str = "event_ts",
    day: str | None = None,
) -> DataFrame:
    """Runs of consecutive observations with the same labels, per segment.

    Runs are cut per (segment, day) chunk; the first run of a day joins the last one of the day before
    when their labels are the same. At one time the labels are ordered by value. The days keep all columns of
    the runs, so that both read the same shuffle. ``day`` names a column that holds the day of the time, for tables that are
    stored by segment and day.
    """
    part = day or "_chunk"
    grain = [key, day, time] if day else [key, time]
    rows = events.filter(present(key, time)).groupBy(*grain, *labels).agg(F.count(F.lit(1)).alias("observations"))
    if day is None:
        rows = rows.withColumn(part, F.to_date(time))
    rows = rows.filter(present(key, part))
    label = F.struct(*labels)
    in_chunk = Window.partitionBy(key, part).orderBy(time, *labels)
    changed = F.when(F.lag(label).over(in_chunk).eqNullSafe(label), 0).otherwise(1)
    runs = (
        rows.withColumn("_change", changed)
        .withColumn("_run", F.sum("_change").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, part, "_run")
        .agg(
            F.first(label).alias("_label"),
            F.min(time).alias("start_ts"),
            F.max(time).alias("end_ts"),
            F.sum("observations").alias("observations"),
        )
    )
    along = Window.partitionBy(key).orderBy(part)
    days = (
        runs.groupBy(key, part)
        .agg(
            F.max("_run").alias("_runs"),
            F.min_by("_label", "_run").alias("_first"),
            F.max_by(F.struct("_label", "start_ts", "end_ts", "observations"), "_run").alias("_last"),
        )
        .withColumn("_before", F.lag("_last").over(along))
        .withColumn("_joins", F.col("_before._label").eqNullSafe(F.col("_first")).cast("int"))
        .withColumn("_new", F.col("_runs") - F.col("_joins"))
        .withColumn("_offset", F.sum("_new").over(along) - F.col("_runs"))
        .select(key, part, "_offset")
    )
    return (
        runs.join(days, [key, part])
        .groupBy(key, (F.col("_offset") + F.col("_run")).alias("episode"))
        .agg(
            F.first("_label").alias("_label"),
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            F.sum("observations").alias("observations"),
        )
        .select(key, "episode", "_label.*", "start_ts", "end_ts", "observations")
    )


def missing_observations(
    events: DataFrame, minutes: int, key: str = "road_segment_id", time: str = "event_ts"
) -> DataFrame:
    """Steps of the observation grid at which a segment has no row.

    The grid runs from the first to the last observed step of the whole table. Instead of building it, each
    segment's observed steps are grouped and only the holes between neighbours are expanded; the two bounds
    of the run stand in as steps just outside it.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    seen = events.filter(present(key, time)).groupBy(key, floor_time(time, minutes).alias("step"))
    seen = seen.agg(F.count(F.lit(1)).alias("n")).select(key, "step")
    low, high = seen.agg(F.min("step")).scalar(), seen.agg(F.max("step")).scalar()
    bounds = seen.groupBy(key).agg(F.lit(True)).select(key, F.explode(F.array(low - step, high + step)).alias("step"))
    walk = with_previous(seen.unionByName(bounds), key, "step", ["step"])
    hole = F.sequence(F.col("previous.step") + step, F.col("step") - step, step)
    return walk.filter(F.col("step") - step > F.col("previous.step")).select(key, F.explode(hole).alias("step"))


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows of each group in the given order; the limit is applied before the shuffle."""
    ranked = df.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("position") <= n)


def cumulative_volume(events: DataFrame, time: str = "event_ts", volume: str = "vehicle_count") -> DataFrame:
    """Running vehicles by hour within each area and day, and their share of the day."""
    hourly = events.groupBy("area", F.to_date(time).alias("day"), F.hour(time).alias("hour")).agg(
        F.sum(volume).alias("vehicles")
    )
    day = Window.partitionBy("area", "day")
    running = F.sum("vehicles").over(day.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("vehicles").over(day)
    return hourly.withColumn("running_vehicles", running).withColumn(
        "day_share", F.when(total != 0, F.col("running_vehicles") / total)
    )


def arrival_order(events: DataFrame, arrival: str = "generated_at", then: Sequence[str] = ("event_id",)) -> DataFrame:
    """All rows sorted by arrival.

    The sort is split by ranges of its keys. Rows that agree on all of them are spread by their input
    position, so a large group of copies does not end up in one range.
    """
    spread = events.withColumn("_position", F.monotonically_increasing_id())
    return spread.orderBy(arrival, *then, "_position").drop("_position")


def first_arrivals(
    events: DataFrame, n: int, arrival: str = "generated_at", then: Sequence[str] = ("event_id",)
) -> DataFrame:
    """The first n rows by arrival: each task keeps its n best, so the rest is never shuffled."""
    rest = [c for c in events.columns if c != arrival and c not in then]
    return events.orderBy(arrival, *then, *rest).limit(n)
