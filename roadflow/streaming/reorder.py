"""Rows of a stream in order of arrival, whatever order they are read in.

Records are read about in order of their event time; one that was delayed arrives later than its neighbours. Each row is held
until the frontier, the event time that the stream has passed, has passed its arrival too: nothing that is still to
come can have arrived before. Rows are held by blocks of slots of arrival time and by a hash of their id, so no key is hot; a timer
gives a slot out when the frontier passes its end. The frontier is one for the whole stream, so a slot comes out in one
batch, and batches hold slots in order: the sorted batches, one after the other, are the stream in arrival order.

A key costs several calls between Python and the state store, however few rows it holds, so a key is a block of ``BLOCK`` slots, and
the records of a slot that come together are one value. A block that the frontier stands in is written again with what is left.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from roadflow.functions import fixed
from roadflow.session import setting

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT = "_slot"  # end of the slot of arrival time, in milliseconds
GROUP = "_block"
BLOCK = 16  # slots of a key
TOGETHER = 4096  # records that are joined in memory at most
SEPARATOR = "\n"  # JSON texts hold no line ends
SPREAD = "_spread"
RECORD = "_record"
HELD = "held"
BATCH = "batch_id"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Holding(StatefulProcessor):
    """Holds the records of one block and spread until the frontier has passed their slots."""

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState(HELD, T.StructType().add(SLOT, "long").add(RECORD, "string"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        frontier, first = timerValues.getCurrentWatermarkInMs(), None
        for slots in _together(rows):
            for slot in [s for s in slots if s <= frontier]:  # came after its slot was given out
                yield Row(**{SLOT: slot, RECORD: SEPARATOR.join(slots.pop(slot))})
            if slots:
                self.held.appendList([(slot, SEPARATOR.join(records)) for slot, records in slots.items()])
                first = min(slots) if first is None else min(first, *slots)
        if first is not None:
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        frontier, left = timerValues.getCurrentWatermarkInMs(), []
        for slot, records in self.held.get():
            if slot <= frontier:
                yield Row(**{SLOT: slot, RECORD: records})
            else:
                left.append((slot, records))
        if left:
            self.held.put(left)
            self.handle.registerTimer(min(slot for slot, _ in left))
        else:
            self.held.clear()

    def close(self) -> None:
        pass


def _together(rows) -> Iterator[dict[int, list[str]]]:
    """Records by slot, at most ``TOGETHER`` of them at a time."""
    slots, n = {}, 0
    for row in rows:
        slots.setdefault(row[SLOT], []).append(row[RECORD])
        n += 1
        if n == TOGETHER:
            yield slots
            slots, n = {}, 0
    if slots:
        yield slots


def _packed(schema: T.StructType) -> Column:
    """All columns as one text, timestamps in microseconds."""
    columns = [F.unix_micros(f.name).alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name) for f in schema]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _unpacked(rows: DataFrame, schema: T.StructType) -> DataFrame:
    whole = T.StructType([T.StructField(f.name, T.LongType()) if f.dataType == T.TimestampType() else f for f in schema])
    single = rows.select(F.explode(F.split(RECORD, SEPARATOR)).alias(RECORD))
    found = single.select(F.inline(F.array(F.from_json(RECORD, whole))))  # each record is parsed once
    back = {f.name: F.timestamp_micros(f.name) for f in schema if f.dataType == T.TimestampType()}
    return found.withColumns(back) if back else found


def released(
    events: DataFrame,
    arrival: str,
    time: str = "event_ts",
    key: str = "event_id",
    delay: str = fixed.WATERMARK,
    slot_seconds: int = 60,
    spread: int = 32,
) -> DataFrame:
    """The rows of a stream, each in the batch in which the frontier passes the end of its slot.

    ``arrival`` and ``time`` are timestamps; the frontier lies ``delay`` behind the newest ``time``. A row without an arrival
    counts as arrived at its ``time``, one without both is given out at once. Rows that come when their slot is out already are given out at once, so
    no row is lost. Use ``ordered_sink`` to keep the order.
    """
    schema = T.StructType([f for f in events.schema])
    millis = F.unix_millis(F.coalesce(arrival, time))
    end = F.coalesce((F.floor(millis / (slot_seconds * 1000)) + 1) * (slot_seconds * 1000), F.lit(0)).cast("long")
    part = F.pmod(F.xxhash64(key), F.lit(spread)).cast("int")
    rows = events.withWatermark(time, delay).select(end.alias(SLOT), part.alias(SPREAD), _packed(schema).alias(RECORD))
    block = F.floor(F.col(SLOT) / (BLOCK * slot_seconds * 1000)).cast("long")
    given = rows.withColumn(GROUP, block).groupBy(GROUP, SPREAD).transformWithState(
        statefulProcessor=Holding(),
        outputStructType=T.StructType().add(SLOT, "long").add(RECORD, "string"),
        outputMode="append",
        timeMode="eventtime",
    )
    return _unpacked(given, schema)


def ordered_sink(
    rows: DataFrame, path: str, checkpoint: str, arrival: str, key: str = "event_id", drain: bool = False
) -> StreamingQuery:
    """Write every batch, sorted by arrival, to a folder by its number; a repeated batch replaces its own folder.

    Sorting reads a batch twice, once for the ranges, so it is kept: else the state would be gone through twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            whole = rows.orderBy(arrival, key).write.mode("overwrite").option("partitionOverwriteMode", "static")
            whole.parquet(f"{path}/{BATCH}={number}")
        finally:
            rows.unpersist()

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    with setting(rows.sparkSession, "spark.sql.streaming.stateStore.providerClass", PROVIDER):  # read when a query starts
        return writer.start()


def in_order(spark: SparkSession, path: str, schema: T.StructType, arrival: str, key: str = "event_id") -> DataFrame:
    """What ``ordered_sink`` has written so far, batch by batch: the rows in arrival order up to the frontier."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(whole).parquet(path).orderBy(BATCH, arrival, key)


def still_held(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """Rows that the stream has read and not given out yet, from its state."""
    state = spark.read.format("statestore").option("stateVarName", HELD).load(checkpoint)
    return _unpacked(state.select(F.col(f"list_element.{RECORD}").alias(RECORD)), schema)
