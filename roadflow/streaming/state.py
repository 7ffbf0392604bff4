"""What a streaming job holds in its state, read from its checkpoint while it runs or when it has stopped.

State has to shrink as the watermark moves on. The audit shows whether it does: how many keys each operator holds, when the
next of them leaves, and how many the watermark has passed already. All of it is read partition by partition in Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORE, OPERATORS = "statestore", "state-metadata"
DEDUP, WINDOWS = "dedupeWithinWatermark", "stateStoreSave"  # names that Spark gives its operators


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per operator with state: number, name, partitions, and the batches whose state can be read."""
    return spark.read.format(OPERATORS).load(checkpoint).select(
        "operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId"
    )


def _only(spark: SparkSession, checkpoint: str, name: str) -> int:
    found = operators(spark, checkpoint).filter(F.col("operatorName") == name).select("operatorId").collect()
    if len(found) != 1:  # a query has a handful of operators
        raise ValueError(f"{len(found)} operators {name} in {checkpoint}")
    return found[0][0]


def _state(spark: SparkSession, checkpoint: str, name: str, batch: int | None) -> DataFrame:
    reader = spark.read.format(STORE).option("operatorId", _only(spark, checkpoint, name))
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def watermark(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: the watermark that the last batch ran with; NULL before there is one."""
    log = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    header = F.get_json_object(F.split("value", "\n").getItem(1), "$.batchWatermarkMs").cast("long")
    return log.agg(F.timestamp_millis(F.max(F.when(header > 0, header))).alias("watermark"))


def held_ids(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Ids that the deduplication still knows: the key columns, when each leaves the state, and its partition.

    ``batch`` reads the state after an earlier batch, as long as Spark keeps it.
    """
    rows = _state(spark, checkpoint, DEDUP, batch)
    expires = F.timestamp_micros("value.expiresAtMicros").alias("expires")
    return rows.select("key.*", expires, "partition_id")


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Windows that have not been emitted yet: their keys, the end of each as ``expires``, and its partition."""
    rows = _state(spark, checkpoint, WINDOWS, batch)
    return rows.select("key.*", F.col("key.window.end").alias("expires"), "partition_id")


def audit(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per operator of the metrics job: keys held, the most in one partition, the first and last to leave, the watermark,
    and the number of keys that it has passed. That number is 0 when state shrinks as it should.

    A key in state leaves when the watermark reaches its time, so ``overdue`` counts those at or behind it.
    """
    readers = {DEDUP: held_ids, WINDOWS: open_windows}
    names = [r.operatorName for r in operators(spark, checkpoint).select("operatorName").collect() if r.operatorName in readers]
    if not names:
        raise ValueError(f"no deduplication and no windows in {checkpoint}")
    rows = reduce(DataFrame.unionByName, [_keys(readers[n](spark, checkpoint), n) for n in names])
    mark = watermark(spark, checkpoint).scalar()
    by_partition = rows.groupBy("operator", "partition_id").agg(
        F.count("expires").alias("n"),
        F.min("expires").alias("low"),
        F.max("expires").alias("high"),
        F.count(F.when(F.col("expires") <= mark, 1)).alias("passed"),
    )
    return by_partition.groupBy("operator").agg(
        F.sum("n").alias("held"),
        F.max("n").alias("most_in_partition"),
        F.min("low").alias("next_to_leave"),
        F.max("high").alias("last_to_leave"),
        F.max(mark).alias("watermark"),
        F.sum("passed").alias("overdue"),
    )


def _keys(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(F.lit(name).alias("operator"), "expires", "partition_id")
