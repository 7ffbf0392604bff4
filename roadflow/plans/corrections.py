"""Window metrics that late rows correct: partial aggregates that can be merged, kept by day.

The stream closes a window and does not open it again; rows that come later are in the raw lake only. Here every load
folds its rows into sums, counts and ranks by window, from which the averages follow exactly, so a correction reads the
new rows and the partials of the days they touch, not the raw lake.

An event counts once, with its newest record. Which ids were folded, and with what, is kept beside the partials, by load and day: a
newer record of a known id takes the old one's readings back out of the sums. A maximum cannot be taken back, so partials
count events by rank, and the peak is the highest rank with a count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.labels import rank_label
from roadflow.functions.measures import rounded_ratio
from roadflow.operators.dedup import keep_latest
from roadflow.operators.windows import GRAIN, exact_rank
from roadflow.session import staged
from roadflow.sources.tables import publish, table_name

DAY = "day"
AVERAGES = {"avg_vehicle_count": "vehicle_count", "avg_speed_kmph": "avg_speed_kmph", "avg_occupancy_pct": "occupancy_pct"}
FOLDED, PARTIALS = "folded_events", "window_partials"


def _ranks(levels: Sequence[str]) -> list[str]:
    return [f"n_rank_{k}" for k in range(1, len(levels) + 1)]


def contributions(
    events: DataFrame, decimals: Mapping[str, int], width: str = fixed.WINDOW, levels: Sequence[str] = fixed.RANKED_LEVELS
) -> DataFrame:
    """What each event adds to its window: event_id, generated_at, day, window_start, window_end, the grain, units and counts."""
    rank = exact_rank(levels)
    columns: dict[str, Column] = {"events": F.lit(1).cast("long")}
    for c in AVERAGES.values():
        units = F.round(F.col(c) * float(10 ** decimals[c])).cast("long")
        columns |= {f"sum_{c}": F.coalesce(units, F.lit(0)), f"n_{c}": F.col(c).isNotNull().cast("long")}
    columns |= {name: F.coalesce((rank == k).cast("long"), F.lit(0)) for k, name in enumerate(_ranks(levels), 1)}
    window = F.window("event_ts", width)
    return events.select(
        "event_id",
        "generated_at",
        F.to_date("event_ts").alias(DAY),
        window["start"].alias("window_start"),
        window["end"].alias("window_end"),
        *GRAIN,
        *[value.alias(name) for name, value in columns.items()],
    )


def _measures(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == "events" or c.startswith(("sum_", "n_"))]


def merged(partials: DataFrame) -> DataFrame:
    """Partials of any origin, one row a window; windows whose events all moved away are gone."""
    keys = [DAY, "window_start", "window_end", *GRAIN]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _measures(partials)]).filter("events > 0")


def finished(
    partials: DataFrame, decimals: Mapping[str, int], levels: Sequence[str] = fixed.RANKED_LEVELS
) -> DataFrame:
    """Window metrics of merged partials, as ``window_metrics`` computes them from the events."""
    averages = [rounded_ratio(F.col(f"sum_{c}"), F.col(f"n_{c}"), decimals[c]).alias(name) for name, c in AVERAGES.items()]
    peak = F.coalesce(*[F.when(F.col(name) > 0, F.lit(k)) for k, name in reversed(list(enumerate(_ranks(levels), 1)))])
    return partials.select(
        "window_start",
        "window_end",
        *GRAIN,
        F.col("events").alias("event_count"),
        *averages,
        rank_label(peak, levels).alias("peak_congestion_level"),
    )


def fold(new: DataFrame, decimals: Mapping[str, int], layer: str, number: int) -> int:
    """Fold the cleaned rows of load ``number`` into the tables of ``layer``; returns how many windows change.

    Loads are folded in the order of their numbers. What a load changes is stored under its number and follows from the new rows
    and earlier loads alone, so a load that failed half way is folded again and replaces what it left. An event is an id on a day.
    """
    spark = new.sparkSession
    newest = ["generated_at", "load"]
    key = ["event_id", DAY]
    fresh = contributions(new, decimals).withColumn("load", F.lit(number).cast("long"))
    fresh = staged(keep_latest(fresh, key, ["generated_at", "window_start"]), "fresh")
    days = [r[DAY] for r in fresh.select(DAY).distinct().collect()]  # one value a day
    folded = table_name(FOLDED, layer)
    if spark.catalog.tableExists(folded):
        earlier = spark.table(folded).filter(F.col(DAY).isin(days)).filter(F.col("load") < number).select(*fresh.columns)
        earlier = earlier.join(fresh.select(*key), key, "left_semi")
        known = staged(keep_latest(earlier, key, newest), "known")
    else:
        known = fresh.limit(0)
    changed = staged(keep_latest(known.unionByName(fresh), key, newest).filter(F.col("load") == number), "changed")
    gone = known.join(changed.select(*key), key, "left_semi")
    measures = _measures(fresh)
    minus = gone.withColumns({c: -F.col(c) for c in measures} | {"load": F.lit(number).cast("long")})
    both = changed.unionByName(minus.select(*changed.columns))
    touched = both.groupBy("load", DAY, "window_start", "window_end", *GRAIN).agg(*[F.sum(c).alias(c) for c in measures])
    touched = staged(touched, "touched")
    publish(changed, FOLDED, layer, partition_by=["load", DAY])
    publish(touched, PARTIALS, layer, partition_by=["load", DAY])  # last: with it the load counts
    return touched.count()


def corrected(spark: SparkSession, layer: str, decimals: Mapping[str, int]) -> DataFrame:
    """Metrics of all windows, late rows included."""
    return finished(merged(spark.table(table_name(PARTIALS, layer))), decimals)
