"""Overlapping spells of weather, [start, end), flattened to intervals in which one condition holds.

A spell is two marks, one that opens its condition and one that closes it. Marks of one area and time are summed
before anything is sorted, and running counts are taken within (area, chunk of time); what is open when a chunk begins
comes from the sums of the chunks before it. So a spell of a month costs two rows, as one of a minute does,
and no task sorts more than a chunk of one area. The part that is ordered per area has one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.labels import label_rank, rank_label


def _highest(counts: Sequence[Column]) -> Column:
    """Rank of the most severe condition that is open; NULL when none is."""
    ranked = [F.when(n > 0, F.lit(k)) for k, n in enumerate(counts, 1)]
    return F.coalesce(*reversed(ranked))


def flatten_spells(
    spells: DataFrame,
    key: str = "area",
    start: str = "start_ts",
    end: str = "end_ts",
    label: str = "weather",
    labels: Sequence[str] = fixed.WEATHER,
    chunk: str = "DAY",
) -> DataFrame:
    """Per key, disjoint intervals with the most severe condition that holds in them: key, start_ts, end_ts,
    weather_rank, area_weather.

    Neighbouring intervals differ in their condition; times that no spell covers have no interval. Spells without a key,
    a known label or a positive length are not read, repeated spells change nothing. ``chunk`` is the stretch of time that
    one task sorts.
    """
    steps = [f"_step{k}" for k in range(1, len(labels) + 1)]
    marks = (
        spells.select(key, F.col(start).alias("_from"), F.col(end).alias("_to"), label_rank(label, labels).alias("_rank"))
        .filter((F.col("_from") < F.col("_to")) & F.col("_rank").isNotNull() & F.col(key).isNotNull())
        .select(
            key,
            "_rank",
            F.inline(
                F.array(
                    F.struct(F.col("_from").alias("_at"), F.lit(1).alias("_step")),
                    F.struct(F.col("_to").alias("_at"), F.lit(-1).alias("_step")),
                )
            ),
        )
        .groupBy(key, "_at")
        .agg(*[F.sum(F.when(F.col("_rank") == k, F.col("_step")).otherwise(0)).alias(c) for k, c in enumerate(steps, 1)])
        .filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in steps]))
        .withColumn("_chunk", F.date_trunc(chunk, "_at"))
    )
    along = Window.partitionBy(key).orderBy("_chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    opened = (
        marks.groupBy(key, "_chunk")
        .agg(*[F.sum(c).alias(c) for c in steps])
        .select(key, "_chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_open") for c in steps])
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("_at")
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, 0)
    running = [F.col(f"{c}_open") + F.sum(c).over(so_far) for c in steps]
    levels = marks.join(opened, [key, "_chunk"]).select(
        key,
        "_chunk",
        "_at",
        _highest(running).alias("weather_rank"),
        _highest([F.col(f"{c}_open") for c in steps]).alias("_at_first"),
    )
    inherited = F.when(F.row_number().over(in_chunk) == 1, F.col("_at_first")).otherwise(
        F.lag("weather_rank").over(in_chunk)
    )
    changes = (
        levels.withColumn("_previous", inherited)
        .filter(~F.col("weather_rank").eqNullSafe(F.col("_previous")))
        .select(key, "_chunk", "_at", "weather_rank")
    )
    following = (
        changes.groupBy(key, "_chunk")
        .agg(F.min("_at").alias("_first"))
        .select(key, "_chunk", F.lead("_first").over(along).alias("_next"))
    )
    return (
        changes.join(following, [key, "_chunk"])
        .withColumn("end_ts", F.coalesce(F.lead("_at").over(in_chunk), "_next"))
        .filter("weather_rank IS NOT NULL")
        .select(
            key, F.col("_at").alias("start_ts"), "end_ts", "weather_rank", rank_label("weather_rank", labels).alias("area_weather")
        )
    )
