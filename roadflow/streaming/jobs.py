"""The streaming job: one source; sinks for raw events, five-minute metrics, rejected records and dead letters.

All branches are the batch functions applied to a streaming DataFrame. Raw events are stored as they come;
only the metrics branch has a watermark, drops repeated ids and loses rows that come after their window
closed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadflow.functions import fixed
from roadflow.functions.times import wall_clock
from roadflow.operators import records
from roadflow.operators.dedup import keep_first
from roadflow.operators.windows import window_metrics
from roadflow.session import path_exists
from roadflow.sources.contract import EVENT_SCHEMA


def file_stream(spark: SparkSession, path: str, max_files: int | None = None, kind: str = "text") -> DataFrame:
    """Replay of a folder of JSON-lines files in order of arrival, as the topic would deliver them.

    ``max_files`` limits a trigger; 1 replays file by file.
    """
    reader = spark.readStream.format(kind)
    if kind == "text":
        reader = reader.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def clean_stream(
    raw: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    lenient: bool = False,
    levels: Sequence[str] = fixed.RANKED_LEVELS,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parsed, timed and cleaned events of a message stream (or of a batch of messages)."""
    return records.clean(parsed_stream(raw, schema, lenient), levels, aliases)


def parsed_stream(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA, lenient: bool = False) -> DataFrame:
    parsed = records.with_event_time(records.flatten_json(raw, schema))
    return records.with_missing_markers_removed(parsed, lenient=lenient)


def rejects_branch(parsed: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """What cleaning drops, with the reasons."""
    return records.rejected(parsed, aliases=aliases)


def raw_branch(cleaned: DataFrame) -> DataFrame:
    return records.raw_projection(cleaned)


def dedup_branch(cleaned: DataFrame, delay: str = fixed.WATERMARK) -> DataFrame:
    """First arrival of each id; an id leaves the state once the watermark has passed it."""
    return keep_first(cleaned.withWatermark("event_ts", delay), ["event_id"])


def metrics_branch(cleaned: DataFrame, delay: str = fixed.WATERMARK, **options) -> DataFrame:
    return window_metrics(dedup_branch(cleaned, delay), **options)


def parquet_sink(
    df: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    drain: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder; ``drain`` stops after all data present at the start."""
    writer = (
        df.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def run(
    raw: DataFrame,
    folder: str,
    drain: bool = False,
    lenient: bool = False,
    aliases: Mapping[str, str] | None = None,
    delay: str = fixed.WATERMARK,
) -> tuple[StreamingQuery, ...]:
    """Start all sinks under one folder: raw, metrics, rejects and dead letters.

    Every message is in exactly one of raw, rejects (readable, but dropped by cleaning, with the reasons) and
    dead_letters (no JSON object, with the reason). Raw events are partitioned by local day so that readers can skip
    days.
    """
    readable, dead = records.split_dead_letters(raw)
    parsed = parsed_stream(readable, lenient=lenient)
    cleaned = records.clean(parsed, aliases=aliases)
    raw_rows = raw_branch(cleaned).withColumn("event_date", F.to_date(wall_clock("event_ts")))
    raw_query = parquet_sink(
        raw_rows, "traffic_raw", f"{folder}/raw", f"{folder}/checkpoints/raw", ["event_date"], drain
    )
    metrics_query = parquet_sink(
        metrics_branch(cleaned, delay, with_rank=True),
        "traffic_metrics",
        f"{folder}/metrics",
        f"{folder}/checkpoints/metrics",
        drain=drain,
    )
    others = {"rejects": rejects_branch(parsed, aliases), "dead_letters": dead}
    return raw_query, metrics_query, *(
        parquet_sink(df, f"traffic_{name}", f"{folder}/{name}", f"{folder}/checkpoints/{name}", drain=drain)
        for name, df in others.items()
    )


def outputs_of(
    raw: DataFrame, lenient: bool = False, aliases: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Raw events, rejects and dead letters of some messages, by output; every message is in exactly one of them."""
    readable, dead = records.split_dead_letters(raw)
    parsed = parsed_stream(readable, lenient=lenient)
    raw_rows = raw_branch(records.clean(parsed, aliases=aliases))
    return {
        "raw": raw_rows.withColumn("event_date", F.to_date(wall_clock("event_ts"))),
        "rejects": rejects_branch(parsed, aliases),
        "dead_letters": dead,
    }


def shared_read(
    raw: DataFrame,
    folder: str,
    outputs: Callable[[DataFrame], Mapping[str, DataFrame]] = outputs_of,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    drain: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """One query for all outputs that need no state: each batch is read from the source once and kept for its outputs.

    An output's rows of a batch are in ``<output>/batch_id=<n>``, and its success marker, which the write leaves last, says that
    it is whole. A batch that is tried again after a failure writes the outputs that have no marker and leaves the others, so
    none is missing and none is repeated. By default raw is partitioned by local day. Needs a file system
    whose committer leaves ``_SUCCESS``, as Spark's own do.
    """
    days = {"raw": ["event_date"]} if partition_by is None else partition_by

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            for name, part in outputs(rows).items():
                path = f"{folder}/{name}/batch_id={number}"
                if not path_exists(batch.sparkSession, f"{path}/_SUCCESS"):
                    whole = part.write.mode("overwrite").option("partitionOverwriteMode", "static")
                    whole.partitionBy(*days.get(name, ())).parquet(path)
        finally:
            rows.unpersist()

    writer = (
        raw.writeStream.queryName("traffic_outputs")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoints/outputs")
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stored_raw(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of the raw events that ``shared_read`` has stored, for branches with state: they read and parse no message again.

    Only whole files are seen. ``batch_id`` says with which batch an event came.
    """
    empty = spark.createDataFrame([], "value string")
    columns = outputs_of(empty)["raw"].schema.add("batch_id", "long")
    reader = spark.readStream.schema(columns)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/raw")


def wait(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait for the queries; the first failure stops the others and is raised."""
    try:
        while any(q.isActive for q in queries):
            # With a limit: a query that ended just before the reset below is not announced again.
            spark.streams.awaitAnyTermination(1)
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            spark.streams.resetTerminated()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        spark.streams.resetTerminated()  # else the next wait in this session meets this failure again
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
