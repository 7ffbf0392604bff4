import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from roadflow.functions.times import event_instant
from roadflow.registry import q_streams
from roadflow.sources.files import message
from roadflow.streaming import jobs, reorder


def timed_messages(spark, n):
    at = F.timestamp_seconds(F.lit(1_772_000_000) + F.col("id") * 60)
    return spark.range(0, n, 1, 6).select(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+05:30'").alias("event_timestamp"), "id").select(
        message(["event_timestamp", "id"]).alias("value")
    )


def test_a_span_is_written_by_several_tasks_and_read_by_one_trigger(spark, tmp_path):
    folder, files = q_streams.sliced(timed_messages(spark, 4000), "slices")
    assert files > 1
    sizes = [p.stat().st_size for p in Path(folder.removeprefix("file:")).glob("part-*")]
    assert len(sizes) == q_streams.SLICES * files and sum(s > 0 for s in sizes) > q_streams.SLICES
    spans = []

    def note(batch, number):
        at = event_instant(F.get_json_object("value", "$.event_timestamp"))
        spans.append(batch.agg(F.min(at), F.max(at), F.count(F.lit(1))).first())

    source = jobs.file_stream(spark, folder, files)
    run = source.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert len(spans) == q_streams.SLICES and sum(s[2] for s in spans) == 4000
    assert all(one[1] < two[0] for one, two in zip(spans, spans[1:]))


class Handle:
    """What the state store does for one key, with the number of calls."""

    def __init__(self):
        self.values, self.timers, self.calls = [], set(), 0

    def getListState(self, name, schema):
        return self

    def appendList(self, values):
        self.calls, self.values = self.calls + 1, self.values + values

    def put(self, values):
        self.values = list(values)

    def get(self):
        return iter(list(self.values))

    def clear(self):
        self.values = []

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_a_block_costs_few_calls_and_gives_slots_out_one_by_one():
    holding, handle = reorder.Holding(), Handle()
    holding.init(handle)
    rows = [{reorder.SLOT: 60_000 * (k % 16 + 1), reorder.RECORD: f"r{k}"} for k in range(800)]
    assert list(holding.handleInputRows((0, 0), iter(rows), Clock(0))) == []
    assert handle.calls == 2 and handle.timers == {60_000}
    given = list(holding.handleExpiredTimer((0, 0), Clock(125_000), None))
    assert {r[reorder.SLOT] for r in given} == {60_000, 120_000} and 180_000 in handle.timers
    assert sum(len(r[reorder.RECORD].split(reorder.SEPARATOR)) for r in given) == 100
    late = list(holding.handleInputRows((0, 0), iter(rows[:16]), Clock(125_000)))
    assert sorted(r[reorder.SLOT] for r in late) == [60_000, 120_000]
    rest = list(holding.handleExpiredTimer((0, 0), Clock(10**9), None))
    assert sum(len(r[reorder.RECORD].split(reorder.SEPARATOR)) for r in rest) == 714 and not handle.values


def test_outputs_read_messages_that_are_made_once(spark, tmp_path, monkeypatch):
    from roadflow.registry import QUERIES

    start, seen = dt.datetime(2024, 3, 1, 7, 30), []
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    kinds = ["view", "purchase"]
    rows = [(n, start + dt.timedelta(minutes=n), n % 4 + 1, kinds[n % 2], 20.0 + n, '{"k": %d}' % (n % 50)) for n in range(1, 41)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    run = jobs.run
    monkeypatch.setattr(jobs, "run", lambda sent, *a, **k: seen.append(sent._jdf.queryExecution().logical().toString()) or run(sent, *a, **k))
    found = {r.output: r.n for r in QUERIES["stream_outputs"](spark, str(tmp_path)).collect()}
    assert sum(found.values()) == 60 and found["dead_letters"] == 20
    assert "to_json" not in seen[0] and "inline" not in seen[0]
