"""Tables laid out by segment and day, so that work along a segment moves no reading again.

A table is bucketed by (segment, local day) and sorted by time inside. A day of a segment lies in one bucket whole, and
a segment that holds a third of all rows is spread over its days. Gaps, episodes and the newest attributes first work by (segment, day),
which needs no exchange here; only what is left of a day is exchanged to go along the segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.operators import sequences
from roadflow.operators.dedup import keep_latest_by_part
from roadflow.sources.tables import layer_database, table_name

SEGMENT, TIME, DAY = "road_segment_id", "event_ts", "event_date"
ATTRIBUTES = ["area", "road_name", "latitude", "longitude"]
NEWEST = ["generated_at", "event_ts"]


def write_by_segment(
    events: DataFrame,
    name: str,
    buckets: int,
    layer: str | None = None,
    path: str | None = None,
    append: bool = False,
) -> str:
    """Write events as a table bucketed by segment and day; returns its name.

    Rows are brought to their bucket first, so a write leaves one file a bucket. ``buckets`` is fixed for the life of the
    table: ``session.shuffle_width`` of its size in GB is a good number, as one task reads a bucket. ``append`` adds a load
    to a table with the same number of buckets; it adds a file a bucket. With ``path`` the files lie there and outlive the table's name.
    """
    spark, full = events.sparkSession, table_name(name, layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer_database(layer)}")
    rows = events.withColumn(DAY, F.to_date(TIME)).repartition(buckets, SEGMENT, DAY)
    writer = rows.write.mode("append" if append else "overwrite")
    writer = writer.bucketBy(buckets, SEGMENT, DAY).sortBy(SEGMENT, DAY, TIME)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(full)
    return full


def gaps(spark: SparkSession, full: str) -> DataFrame:
    """``sequences.observation_gaps`` of a laid-out table."""
    return sequences.observation_gaps(spark.table(full), SEGMENT, TIME, day=DAY)


def episodes(spark: SparkSession, full: str, labels: Sequence[str]) -> DataFrame:
    """``sequences.episodes`` of a laid-out table."""
    return sequences.episodes(spark.table(full), labels, SEGMENT, TIME, day=DAY)


def segment_latest(spark: SparkSession, full: str) -> DataFrame:
    """``marts.dim_road_segment`` of a laid-out table: the newest record of each day, and of those the newest.

    Rows that tie lie in one day, so the choice among them is made there, as it is without the layout.
    """
    rows = spark.table(full).select(SEGMENT, DAY, *ATTRIBUTES, *NEWEST)
    return keep_latest_by_part(rows, [SEGMENT], DAY, NEWEST).select(SEGMENT, *ATTRIBUTES)
