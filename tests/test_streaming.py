import json
import os
from pathlib import Path

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from wire_records import event
from roadflow.operators.dedup import keep_first
from roadflow.operators.windows import window_metrics
from roadflow.streaming import jobs


def at(clock, **changes):
    day = "2026-07-01"
    stamp = f"{day}T{clock}:00+05:30"
    compact = clock.replace(":", "")
    return event(event_id=f"WFD-001_20260701T{compact}00", event_timestamp=stamp, generated_at=stamp, **changes)


class Folder:
    """JSON-lines files that arrive one after the other."""

    def __init__(self, path):
        self.path, self.n = Path(path), 0
        self.path.mkdir()

    def arrive(self, *records):
        self.n += 1
        file = self.path / f"part-{self.n:05d}.json"
        file.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
        os.utime(file, (1_700_000_000 + self.n * 60,) * 2)


@pytest.fixture
def lake(tmp_path):
    return Folder(tmp_path / "in"), str(tmp_path / "out")


def run(spark, folder, out, **options):
    queries = jobs.run(jobs.file_stream(spark, str(folder.path), max_files=1), out, drain=True, **options)
    jobs.wait(spark, *queries)
    return queries


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{name}")


def test_raw_keeps_all_and_metrics_drop_copies_and_late_rows(spark, lake):
    folder, out = lake
    folder.arrive(at("08:00", vehicle_count=10), at("08:00", vehicle_count=10, anomaly_type="Duplicate"), "broken")
    folder.arrive(at("08:01", vehicle_count=20), at("08:40"))
    folder.arrive(at("08:41"))
    folder.arrive(at("08:02", vehicle_count=90))
    folder.arrive(at("12:00"))
    run(spark, folder, out)
    assert read(spark, out, "raw").count() == 7
    metrics = read(spark, out, "metrics").orderBy("window_start").collect()
    assert [(r.event_count, r.avg_vehicle_count) for r in metrics] == [(2, 15.0), (2, 10.0)]
    assert metrics[0].peak_congestion_rank == 1 and metrics[0].peak_congestion_level == "Low"
    days = {str(r.event_date) for r in read(spark, out, "raw").select("event_date").distinct().collect()}
    assert days <= {"2026-07-01"}


def test_restart_repeats_nothing(spark, lake):
    folder, out = lake
    folder.arrive(at("08:00"))
    run(spark, folder, out)
    run(spark, folder, out)
    assert read(spark, out, "raw").count() == 1
    folder.arrive(at("08:01"))
    run(spark, folder, out)
    assert read(spark, out, "raw").count() == 2


def test_batch_recompute_equals_stream_without_late_rows(spark, lake):
    folder, out = lake
    for hour in range(8, 12):
        folder.arrive(*[at(f"{hour:02d}:{m:02d}", vehicle_count=m, congestion_level="High") for m in range(0, 60, 2)])
    folder.arrive(at("23:00"))
    run(spark, folder, out)
    batch = window_metrics(keep_first(read(spark, out, "raw")), with_rank=True).filter(F.hour("window_start") < 17)
    stream = read(spark, out, "metrics").select(*batch.columns)
    assert stream.count() == batch.count() == 48
    assert stream.exceptAll(batch).count() == 0


def test_one_file_per_trigger(spark, lake):
    folder, out = lake
    for minute in range(3):
        folder.arrive(at(f"08:0{minute}"), at(f"09:0{minute}"))
    raw_query, *_ = run(spark, folder, out)
    assert [p["numInputRows"] for p in raw_query.recentProgress if p["numInputRows"]] == [2, 2, 2]


def test_state_of_old_ids_is_released(spark, lake):
    folder, out = lake
    for hour in range(6, 12):
        folder.arrive(at(f"{hour:02d}:00"))
    _, metrics_query, *_ = run(spark, folder, out)
    sizes = [p["stateOperators"][-1]["numRowsTotal"] for p in metrics_query.recentProgress]
    dedup = [min(s["numRowsTotal"] for s in p["stateOperators"]) for p in metrics_query.recentProgress]
    assert max(dedup) <= 2 and max(sizes) <= 3


def test_level_aliases_reach_the_metrics(spark, lake):
    folder, out = lake
    folder.arrive(at("08:00", congestion_level="Moderate"))
    folder.arrive(at("10:00"))
    run(spark, folder, out, aliases={"Moderate": "Medium"})
    assert read(spark, out, "metrics").first().peak_congestion_level == "Medium"


def test_failure_stops_the_other_query(spark, lake, tmp_path):
    folder, out = lake
    folder.arrive(at("08:00"))
    source = jobs.file_stream(spark, str(folder.path), max_files=1)
    failing = source.select(F.raise_error(F.lit("stop here")).cast("string").alias("value"))
    good = jobs.parquet_sink(source, "good", str(tmp_path / "good"), str(tmp_path / "good-cp"), interval="1 second")
    bad = jobs.parquet_sink(failing, "bad", str(tmp_path / "bad"), str(tmp_path / "bad-cp"), interval="1 second")
    with pytest.raises(StreamingQueryException):
        jobs.wait(spark, good, bad)
    assert not good.isActive and not bad.isActive


def shared(spark, folder, out, **options):
    query = jobs.shared_read(jobs.file_stream(spark, str(folder.path), max_files=1), out, drain=True, **options)
    jobs.wait(spark, query)
    return query


def test_one_read_feeds_all_outputs(spark, lake):
    folder, out = lake
    for hour in range(8, 11):
        folder.arrive(*[at(f"{hour:02d}:{m:02d}", vehicle_count=m) for m in range(0, 60, 5)], "broken", at("08:01", vehicle_count=-1))
    folder.arrive(at("08:00", vehicle_count=77, anomaly_type="Duplicate"), at("23:00"))
    query = shared(spark, folder, out)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [14, 14, 14, 2]
    assert [read(spark, out, name).count() for name in ("raw", "rejects", "dead_letters")] == [38, 3, 3]
    assert shared(spark, folder, out).recentProgress == [] or read(spark, out, "raw").count() == 38
    metrics = jobs.metrics_branch(jobs.stored_raw(spark, out), with_rank=True)
    jobs.wait(spark, jobs.parquet_sink(metrics, "stored", f"{out}/metrics", f"{out}/cp", drain=True))
    other = f"{out}-each"
    run(spark, folder, other)
    found, wanted = read(spark, out, "metrics"), read(spark, other, "metrics")
    assert found.select(wanted.columns).exceptAll(wanted).count() == 0 and found.count() == wanted.count() > 30


def test_failure_between_two_outputs_repeats_neither(spark, lake):
    folder, out = lake
    folder.arrive(at("08:00"), "broken")
    folder.arrive(at("08:01"), at("08:02", vehicle_count=-1), "broken")
    shared(spark, folder, out)
    folder.arrive(at("08:03"), at("08:04"), "broken", at("08:05", vehicle_count=-1))

    def failing(rows):
        parts = jobs.outputs_of(rows)
        stop = F.raise_error(F.lit("stop here")).cast("string")
        return parts | {"rejects": parts["rejects"].withColumn("reasons", stop)}

    with pytest.raises(StreamingQueryException):
        shared(spark, folder, out, outputs=failing)
    written = {str(p): p.stat().st_mtime_ns for p in Path(out).glob("raw/batch_id=2/**/*.parquet")}
    assert written and read(spark, out, "raw").count() == 4 and read(spark, out, "rejects").count() == 1
    shared(spark, folder, out)
    assert {str(p): p.stat().st_mtime_ns for p in Path(out).glob("raw/batch_id=2/**/*.parquet")} == written
    assert [read(spark, out, name).count() for name in ("raw", "rejects", "dead_letters")] == [4, 2, 3]


def test_every_message_is_in_one_of_three_outputs(spark, lake):
    folder, out = lake
    folder.arrive(at("08:00"), "broken", "[1]", at("08:01", vehicle_count=-1), at("08:02", congestion_level="Odd"))
    folder.arrive(at("08:03"), json.dumps({"event_id": "x"}))
    run(spark, folder, out)
    assert read(spark, out, "raw").count() == 2
    assert sorted(r.reasons for r in read(spark, out, "rejects").collect())[-1] == "vehicle_count_negative"
    assert read(spark, out, "rejects").count() == 3
    assert sorted(r.value for r in read(spark, out, "dead_letters").collect()) == ["[1]", "broken"]


def reorder_run(spark, folder, out, delay="10 minutes"):
    from roadflow.functions.times import event_instant
    from roadflow.streaming import reorder

    rows = jobs.clean_stream(jobs.file_stream(spark, str(folder.path), max_files=1))
    rows = rows.withColumn("arrived", event_instant("generated_at"))
    stream = reorder.released(rows, "arrived", delay=delay, spread=3)
    reorder.ordered_sink(stream, f"{out}/ordered", f"{out}/cp", "arrived", drain=True).awaitTermination()
    found = reorder.in_order(spark, f"{out}/ordered", rows.schema, "arrived").collect()
    held = reorder.still_held(spark, f"{out}/cp", rows.schema).collect()
    return [(r.arrived, r.event_id) for r in found], [(r.arrived, r.event_id) for r in held], found


@pytest.mark.parametrize("sizes", [[200], [3, 50, 1, 96, 50]])
def test_delayed_rows_come_out_in_arrival_order(spark, tmp_path, sizes):
    records, out = [], str(tmp_path / "out")
    for k in range(200):
        minute, lag = 480 + k // 2, (k * 7 % 50 if k % 5 == 0 else 0)
        stamp, sent = (f"2026-07-01T{m // 60:02d}:{m % 60:02d}:{k % 2 * 30:02d}" for m in (minute, minute + lag))
        key = f"WFD-{k:03d}_20260701T000000"
        records.append(event(event_id=key, event_timestamp=f"{stamp}+05:30", generated_at=f"{sent}.5{k % 10}0+05:30", vehicle_count=k))
    folder, at_ = Folder(tmp_path / "in"), 0
    for i, size in enumerate(sizes):  # the stream stops after every file and goes on from its checkpoint
        folder.arrive(*records[at_ : at_ + size])
        at_ += size
        if i % 2 == 0:
            reorder_run(spark, folder, out)
    given, held, rows = reorder_run(spark, folder, out)
    assert len(given) > 120 and len(given) + len(held) == 200 and len(set(given + held)) == 200
    assert given == sorted(given) and (not held or max(given) < min(held))
    assert {r.vehicle_count for r in rows} <= set(range(200)) and all(r.area == "Whitefield" for r in rows)


def test_a_row_behind_the_frontier_is_not_lost(spark, tmp_path):
    folder, out = Folder(tmp_path / "in"), str(tmp_path / "out")
    folder.arrive(at("08:00"), at("12:00"))
    folder.arrive(at("07:00"), at("12:01"))
    given, held, _ = reorder_run(spark, folder, out)
    assert sorted(i[-6:] for _, i in given) == ["070000", "080000"] and len(held) == 2
