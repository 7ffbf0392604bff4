"""Kafka topics as source and sink. Needs Spark's Kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadflow.functions.fixed import TOPIC
from roadflow.operators.records import split_dead_letters
from roadflow.sources.files import keyed_json


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream of a topic; ``starting`` only matters before the first checkpoint.

    ``max_offsets`` limits a trigger. Without it each trigger takes all there is, so a topic never falls behind.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def topic_records(spark: SparkSession, servers: str, topic: str = TOPIC) -> tuple[DataFrame, DataFrame]:
    """All records of a topic from the earliest on: (readable, unreadable with a reason)."""
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return split_dead_letters(raw)


def publish_topic(df: DataFrame, servers: str, topic: str = TOPIC, key: str = "road_segment_id") -> None:
    """Publish each row as JSON under its segment, so a segment's records stay in one topic partition."""
    keyed_json(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
