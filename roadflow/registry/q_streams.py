"""Queries that run the streaming job over the event files and return what its sinks hold."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.times import event_instant, wall_clock
from roadflow.operators.dedup import keep_latest
from roadflow.operators.records import computed_once
from roadflow.operators.windows import window_metrics
from roadflow.plans import corrections
from roadflow.registry.catalog import DECIMALS, VALID_SQL, query, sql_metrics, sql_only, valid_events
from roadflow.registry.observations import messages, observations, observations_of, table
from roadflow.session import scratch_path, setting, staged
from roadflow.streaming import jobs, reorder, state

ALIASES = {"Moderate": "Medium"}

CLEAN_SQL = f"""cleaned AS (SELECT * REPLACE (nullif(nullif(incident_type, ''), 'nan') AS incident_type,
    nullif(anomaly_type, 'nan') AS anomaly_type)
  FROM (SELECT * REPLACE (CASE congestion_level WHEN 'Moderate' THEN 'Medium' ELSE congestion_level END
    AS congestion_level) FROM obs) WHERE {VALID_SQL}),
  once AS ({sql_only('event_id', 'generated_at', 'cleaned')})"""


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of messages."""
    events = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    return messages(observations_of(events)).select("value")


def drained(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over the data at hand into Parquet and read the result back."""
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    run = jobs.parquet_sink(df, path.rsplit("/", 1)[1], path, checkpoint, drain=True)
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return jobs.clean_stream(event_stream(spark, d), aliases=ALIASES)


_ISO = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS event_timestamp"
_SENT = "strftime(generated_at, '%Y-%m-%dT%H:%M:%S.%g') || '+05:30' AS generated_at"


@query(
    "stream_raw",
    f", {CLEAN_SQL}\nSELECT * REPLACE ({_SENT}), {_ISO} FROM cleaned",
)
def stream_raw(spark, d):
    rows = drained(jobs.raw_branch(cleaned(spark, d)), "stream_raw")
    return rows.withColumn("event_ts", wall_clock("event_ts"))


@query(
    "stream_dedup_first",
    f", {CLEAN_SQL}\nSELECT event_id, event_ts, vehicle_count, avg_speed_kmph, congestion_level FROM once",
)
def stream_dedup_first(spark, d):
    rows = drained(jobs.dedup_branch(cleaned(spark, d)), "stream_dedup")
    return rows.select(
        "event_id", wall_clock("event_ts").alias("event_ts"), "vehicle_count", "avg_speed_kmph", "congestion_level"
    )


@query(
    "stream_win5",
    f""", {CLEAN_SQL}
    SELECT * FROM ({sql_metrics('once')})
    WHERE window_end <= (SELECT max(event_ts) - INTERVAL 10 MINUTES FROM cleaned)""",
)
def stream_win5(spark, d):
    """Windows closed by the end of the data; those still open are not emitted."""
    rows = drained(jobs.metrics_branch(cleaned(spark, d), decimals=DECIMALS), "stream_win5")
    times = {c: wall_clock(c) for c in ("window_start", "window_end")}
    return rows.withColumns(times).select(*fixed.METRIC_COLUMNS)


@query(
    "stream_outputs",
    f""", {CLEAN_SQL}
    SELECT 'dead_letters' AS output, count(*) AS n FROM obs WHERE anomaly_type = 'Duplicate'
    UNION ALL SELECT 'raw', count(*) FROM cleaned WHERE anomaly_type IS DISTINCT FROM 'Duplicate'
    UNION ALL SELECT 'rejects', (SELECT count(*) FROM obs WHERE anomaly_type <> 'Duplicate')
      - (SELECT count(*) FROM cleaned WHERE anomaly_type IS DISTINCT FROM 'Duplicate')""",
)
def stream_outputs(spark, d):
    """Rows of the outputs that share the messages among them; copies arrive cut off in the middle."""
    value = F.col("value")
    cut = F.when(F.col("anomaly_type") == "Duplicate", F.left(value, (F.length(value) / 2).cast("int"))).otherwise(value)
    sent, topic = computed_once(messages(observations(spark, d))).select(cut.alias("value")), scratch_path(spark, "topic")
    # Every output reads the messages, none makes them again. Short files, because a file's single row group is one task's.
    sent.write.option("maxRecordsPerFile", 50_000).parquet(topic)
    sent = spark.readStream.schema(sent.schema).parquet(topic)
    folder = scratch_path(spark, "outputs")
    jobs.wait(spark, *jobs.run(sent, folder, drain=True, aliases=ALIASES))
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("output"), "n")
        for name in ("raw", "rejects", "dead_letters")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


SLICES = 4


def sliced(df: DataFrame, name: str) -> tuple[str, int]:
    """Write messages as text files of about equal spans of time, one span after the other; returns the folder and the files of
    a span, the same number for each, so that a trigger of that many files is a span."""
    folder, spark = scratch_path(df.sparkSession, name), df.sparkSession
    at = event_instant(F.get_json_object("value", "$.event_timestamp"))
    rows = staged(df.select("value", F.unix_micros(at).alias("at")), name)
    low, high = rows.agg(F.min("at"), F.max("at")).first()
    width = (high - low) // SLICES + 1
    files = rows.rdd.getNumPartitions()
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        for k in range(SLICES):
            part = rows.filter(F.floor((F.col("at") - low) / width) == k).select("value")
            part.write.mode("append").text(folder)  # a file a task, none from a task without rows
            add_empty_files(spark, folder, (k + 1) * files)
    return folder, files


def add_empty_files(spark: SparkSession, folder: str, wanted: int) -> None:
    """Fill up the data files of a folder to a number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    present = sum(f.getPath().getName().startswith("part-") for f in store.listStatus(path))
    for _ in range(present, wanted):
        store.create(spark._jvm.org.apache.hadoop.fs.Path(path, f"part-{uuid.uuid4().hex}.txt")).close()


@query(
    "stream_shared_read",
    f""", {CLEAN_SQL}
    SELECT * FROM ({sql_metrics('once')})
    WHERE window_end <= (SELECT max(event_ts) - INTERVAL 10 MINUTES FROM cleaned)""",
)
def stream_shared_read(spark, d):
    """Closed windows from the raw events that one query stored batch by batch, next to its other outputs."""
    source = jobs.file_stream(spark, *sliced(messages(observations(spark, d)), "shared"))
    folder = scratch_path(spark, "shared-outputs")
    jobs.wait(spark, jobs.shared_read(source, folder, lambda rows: jobs.outputs_of(rows, aliases=ALIASES), drain=True))
    rows = drained(jobs.metrics_branch(jobs.stored_raw(spark, folder), decimals=DECIMALS), "shared-metrics")
    times = {c: wall_clock(c) for c in ("window_start", "window_end")}
    return rows.withColumns(times).select(*fixed.METRIC_COLUMNS)


@query(
    "stream_reordered",
    f""", {CLEAN_SQL}
    SELECT generated_at, event_id, vehicle_count, anomaly_type, true AS in_order,
      date_trunc('minute', generated_at) + INTERVAL 1 MINUTE <= (SELECT max(event_ts) - INTERVAL 10 MINUTES FROM cleaned)
        AS released
    FROM cleaned""",
)
def stream_reordered(spark, d):
    """Every message read in event order, given out in arrival order: whether a row comes after all rows of earlier batches,
    and whether the frontier has passed it; the rest is read from the stream's state."""
    source = jobs.file_stream(spark, *sliced(messages(observations(spark, d)), "reorder"))
    rows = jobs.clean_stream(source, aliases=ALIASES)
    rows = rows.withColumn("arrived", event_instant("generated_at"))
    path, checkpoint = scratch_path(spark, "reordered"), scratch_path(spark, "reordered-checkpoint")
    reorder.ordered_sink(reorder.released(rows, "arrived"), path, checkpoint, "arrived", drain=True).awaitTermination()
    given = reorder.in_order(spark, path, rows.schema, "arrived")
    spans = given.groupBy(reorder.BATCH).agg(F.min("arrived").alias("low"), F.max("arrived").alias("high"))
    earlier = F.max("high").over(Window.orderBy(reorder.BATCH).rowsBetween(Window.unboundedPreceding, -1))  # a row a batch
    spans = spans.select(reorder.BATCH, earlier.alias("earlier"))
    after = F.col("earlier").isNull() | (F.col("arrived") >= F.col("earlier"))
    out = given.join(spans, reorder.BATCH).select(*rows.columns, after.alias("in_order"), F.lit(True).alias("released"))
    held = reorder.still_held(spark, checkpoint, rows.schema)
    out = out.unionByName(held.select(*rows.columns, F.lit(True).alias("in_order"), F.lit(False).alias("released")))
    return out.select(
        wall_clock("arrived").alias("generated_at"), "event_id", "vehicle_count", "anomaly_type", "in_order", "released"
    )


@query("win5_corrected", sql_metrics("latest"))
def win5_corrected(spark, d):
    """Metrics of three loads with late and repeated rows, folded one after the other; the second is folded twice."""
    layer = f"corrections_{uuid.uuid4().hex}"
    rows = staged(valid_events(spark, d).withColumn("part", F.pmod(F.xxhash64("event_id", "generated_at"), F.lit(3))), "loads")
    for number in (1, 2, 2, 3):
        corrections.fold(rows.filter(F.col("part") == number - 1).drop("part"), DECIMALS, layer, number)
    found = staged(corrections.corrected(spark, layer, DECIMALS), "corrected")
    spark.sql(f"DROP DATABASE {layer} CASCADE")
    return found


_MARK = "(SELECT max(event_ts) - INTERVAL 10 MINUTES FROM cleaned)"


def metrics_state(spark: SparkSession, d: str, name: str) -> str:
    """Run the metrics branch over the data at hand; returns its checkpoint."""
    rows = jobs.metrics_branch(cleaned(spark, d), decimals=DECIMALS)
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    jobs.parquet_sink(rows, path.rsplit("/", 1)[1], path, checkpoint, drain=True).awaitTermination()
    return checkpoint


@query(
    "stream_held_ids",
    f""", {CLEAN_SQL}
    SELECT event_id, event_ts + INTERVAL 10 MINUTES AS expires FROM once
    WHERE event_ts + INTERVAL 10 MINUTES > {_MARK}""",
)
def stream_held_ids(spark, d):
    """Ids that the deduplication still holds after all data; the others have left its state."""
    rows = state.held_ids(spark, metrics_state(spark, d, "held-ids"))
    return rows.select("event_id", wall_clock("expires").alias("expires"))


@query(
    "stream_state_audit",
    f""", {CLEAN_SQL}, held AS (
      SELECT 'dedupeWithinWatermark' AS operator, event_ts + INTERVAL 10 MINUTES AS expires FROM once
      UNION ALL SELECT 'stateStoreSave', window_end FROM ({sql_metrics('once')}))
    SELECT operator, count(*) AS held, min(expires) AS next_to_leave, max(expires) AS last_to_leave,
      {_MARK} AS watermark, 0::BIGINT AS overdue
    FROM held WHERE expires > {_MARK} GROUP BY 1""",
)
def stream_state_audit(spark, d):
    """Keys in the state of each operator after all data, and how many the watermark has passed."""
    found = state.audit(spark, metrics_state(spark, d, "audit"))
    times = {c: wall_clock(c) for c in ("next_to_leave", "last_to_leave", "watermark")}
    return found.withColumns(times).drop("most_in_partition")


_STATE_COLUMNS = "area, road_segment_id"


@query(
    "late_loss",
    f""", {CLEAN_SQL}, batch AS ({sql_metrics('once', _STATE_COLUMNS)})
    SELECT area, count(*) AS batch_windows, count(*) FILTER (window_end <= f) AS streamed_windows,
      count(*) FILTER (window_end > f) AS missing_windows
    FROM batch, (SELECT max(event_ts) - INTERVAL 10 MINUTES AS f FROM cleaned) GROUP BY 1""",
)
def late_loss(spark, d):
    """Windows by area that a batch over the raw sink finds and the stream did not emit."""
    raw = drained(jobs.raw_branch(cleaned(spark, d)), "loss_raw")
    grain = ["area", "road_segment_id"]
    streamed = drained(jobs.metrics_branch(cleaned(spark, d), grain=grain), "loss_metrics")
    keys = ["window_start", *grain]
    batch = window_metrics(keep_latest(raw), grain).select(*keys)
    seen = batch.join(streamed.select(*keys).withColumn("seen", F.lit(1)), keys, "left")
    return seen.groupBy("area").agg(
        F.count(F.lit(1)).alias("batch_windows"),
        F.count("seen").alias("streamed_windows"),
        F.count(F.when(F.col("seen").isNull(), 1)).alias("missing_windows"),
    )
