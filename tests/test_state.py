"""What is left in a stream's state."""

import json

import pytest

from wire_records import event
from roadflow.session import setting
from roadflow.streaming import jobs, state


def at(segment, clock):
    day = "2026-07-01"
    stamp = f"{day}T{clock}:00+05:30"
    return event(
        event_id=f"{segment}_{clock}", road_segment_id=segment, event_timestamp=stamp, generated_at=stamp
    )


PROVIDERS = ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"]


@pytest.fixture(params=PROVIDERS)
def job(spark, tmp_path, request):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    source.mkdir()
    provider = f"org.apache.spark.sql.execution.streaming.state.{request.param}"

    def arrive(number, *records):
        (source / f"part-{number}.json").write_text("".join(json.dumps(r) + "\n" for r in records))
        rows = jobs.metrics_branch(jobs.clean_stream(jobs.file_stream(spark, str(source))))
        with setting(spark, "spark.sql.streaming.stateStore.providerClass", provider):
            jobs.parquet_sink(rows, "state", str(tmp_path / "out"), checkpoint, drain=True).awaitTermination()
        return checkpoint

    return arrive


def ids(spark, checkpoint, **options):
    return {r.event_id for r in state.held_ids(spark, checkpoint, **options).collect()}


def test_ids_and_windows_leave_once_the_watermark_has_passed(spark, job):
    held = job(1, at("WFD-001", "08:00"), at("WFD-001", "08:00"), at("WFD-002", "08:05"))
    assert ids(spark, held) == {"WFD-001_08:00", "WFD-002_08:05"}
    assert state.open_windows(spark, held).count() == 2
    job(2, at("WFD-001", "12:00"))
    assert ids(spark, held) == {"WFD-001_12:00"}
    assert [r.road_segment_id for r in state.open_windows(spark, held).collect()] == ["WFD-001"]
    found = {r.operator: r for r in state.audit(spark, held).collect()}
    assert set(found) == {state.DEDUP, state.WINDOWS}
    for row in found.values():
        assert (row.held, row.overdue, row.most_in_partition) == (1, 0, 1)
        assert row.next_to_leave == row.last_to_leave > row.watermark


def test_state_of_an_earlier_batch(spark, job):
    held = job(1, at("WFD-001", "08:00"))
    job(2, at("WFD-001", "12:00"))
    first = state.operators(spark, held).first()
    assert ids(spark, held, batch=first.minBatchId) == {"WFD-001_08:00"}
    assert ids(spark, held, batch=first.maxBatchId) == {"WFD-001_12:00"}


def test_a_checkpoint_without_the_operator(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(at("WFD-001", "08:00")) + "\n")
    rows = jobs.raw_branch(jobs.clean_stream(jobs.file_stream(spark, str(tmp_path / "in"))))
    checkpoint = str(tmp_path / "checkpoint")
    jobs.parquet_sink(rows, "plain", str(tmp_path / "out"), checkpoint, drain=True).awaitTermination()
    with pytest.raises(Exception):
        state.audit(spark, checkpoint)
