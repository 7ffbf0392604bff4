import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from wire_records import event

from roadflow.plans import marts, staging
from roadflow.plans.build import RAW_SCHEMA, typed_raw
from roadflow.plans.refresh import compact, load_errors, loaded, refresh
from roadflow.sources import ledger
from roadflow.streaming import jobs


def at(day, clock, **changes):
    stamp = f"2026-07-{day}T{clock}:00"
    key = f"WFD-001_202607{day}T{clock.replace(':', '')}00"
    sent = changes.pop("sent", f"{stamp}.000+05:30")
    return event(event_id=key, event_timestamp=f"{stamp}+05:30", generated_at=sent, **changes)


def test_only_touched_days_are_rebuilt(spark, tmp_path):
    lake, warehouse, layer = str(tmp_path / "lake"), str(tmp_path / "warehouse"), "marts_refresh"
    (tmp_path / "in").mkdir()

    def cycle(name=None, *records):
        if name:
            (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))
        jobs.wait(spark, *jobs.run(jobs.file_stream(spark, str(tmp_path / "in")), lake, drain=True))
        return refresh(spark, lake, warehouse, layer=layer)

    def table(name):
        return spark.table(f"{layer}.{name}")

    assert cycle("a.json", at("01", "02:15"), at("01", "02:15", weather="Rain"), at("01", "06:00")) == [date(2026, 7, 1)]
    assert table("fact_traffic_events").count() == 2
    assert cycle() == []
    assert cycle("b.json", at("02", "08:00", road_name="New Road"), at("02", "09:00")) == [date(2026, 7, 1), date(2026, 7, 2)]
    assert table("dim_road_segment").first().road_name == "Main Road"
    resent = at("02", "08:00", vehicle_count=77, sent="2026-07-02T10:00:00.000+05:30", incident_type="Accident")
    assert cycle("c.json", resent, at("03", "01:00", road_name="Last Road")) == [
        date(2026, 7, 2),
        date(2026, 7, 3),
    ]
    facts = {r.event_id: r.vehicle_count for r in table("fact_traffic_events").collect()}
    assert len(facts) == 5 and facts["WFD-001_20260702T080000"] == 77
    assert table("dim_road_segment").first().road_name == "Last Road"
    assert sorted(r.date_key for r in table("dim_date").collect()) == [20260701, 20260702, 20260703]
    assert {r.incident_type for r in table("dim_incident").collect()} == {"None", "Accident"}

    whole = marts.latest_events(staging.stage_events(typed_raw(loaded(spark, warehouse, "raw").drop("load_id", "event_date"))))
    full = marts.fact_events(whole)
    assert table("fact_traffic_events").select(*full.columns).exceptAll(full).count() == 0
    assert table("fact_traffic_events").count() == full.count()
    assert loaded(spark, warehouse, "raw").count() == 7


def test_an_id_that_moves_to_another_day_leaves_the_old_one(spark, tmp_path):
    lake, warehouse, layer = str(tmp_path / "lake"), str(tmp_path / "warehouse"), "marts_moved"
    (tmp_path / "in").mkdir()

    def cycle(name, *records):
        (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))
        jobs.wait(spark, *jobs.run(jobs.file_stream(spark, str(tmp_path / "in")), lake, drain=True))
        return refresh(spark, lake, warehouse, layer=layer)

    cycle("a.json", at("01", "02:15"), at("02", "03:00"), at("02", "04:00"))
    again = at("03", "02:15", sent="2026-07-03T09:00:00.000+05:30") | {"event_id": at("01", "02:15")["event_id"]}
    other = at("03", "03:00", sent="2026-07-03T09:00:00.000+05:30") | {"event_id": at("02", "03:00")["event_id"]}
    assert cycle("b.json", again, other) == [date(2026, 7, 1), date(2026, 7, 2), date(2026, 7, 3)]
    facts = spark.table(f"{layer}.fact_traffic_events").groupBy("date_key").count().collect()
    assert {r.date_key: r["count"] for r in facts} == {20260702: 1, 20260703: 2}


class Job:
    """A lake that a stream fills and refresh reads."""

    def __init__(self, spark, folder, layer):
        self.spark, self.folder, self.layer = spark, folder, layer
        self.lake, self.warehouse = str(folder / "lake"), str(folder / "warehouse")
        (folder / "in").mkdir()

    def cycle(self, name=None, *records):
        if name:
            (self.folder / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))
        jobs.wait(self.spark, *jobs.run(jobs.file_stream(self.spark, str(self.folder / "in")), self.lake, drain=True))
        return refresh(self.spark, self.lake, self.warehouse, layer=self.layer)

    def table(self, name):
        return self.spark.table(f"{self.layer}.{name}")


def test_a_bad_value_is_set_aside_and_a_correction_takes_its_place(spark, tmp_path):
    job = Job(spark, tmp_path, "marts_aside")
    bad = at("01", "02:15", latitude=123.0, hour_of_day=30)
    assert job.cycle("a.json", bad, at("01", "06:00")) == [date(2026, 7, 1)]
    assert [r.event_id[-6:] for r in job.table("fact_traffic_events").collect()] == ["060000"]
    assert [r.failed for r in job.table("events_set_aside").collect()] == ["latitude,hour_of_day"]
    # The stream closes windows of a day while it reads the next, so days of metrics come along.
    assert date(2026, 7, 2) in job.cycle("b.json", at("02", "08:00", longitude=-999.0))
    assert date(2026, 7, 1) in job.cycle("c.json", at("01", "02:15", sent="2026-07-02T09:00:00.000+05:30"))
    assert job.table("fact_traffic_events").count() == 2
    assert sorted(r.failed for r in job.table("events_set_aside").collect()) == ["latitude,hour_of_day", "longitude"]


def test_the_index_answers_which_days_hold_an_id(spark, tmp_path):
    from roadflow.plans import refresh as module

    job = Job(spark, tmp_path, "marts_index")
    job.cycle("a.json", *[at("01", f"{h:02d}:15") for h in range(1, 20)], at("02", "03:00"))
    index = job.table("event_days")
    assert index.count() == 20 and index.select("id_bucket").distinct().count() > 5
    ids = module.new_ids(loaded(spark, job.warehouse, "raw").filter("hour(event_ts) = 0"), 0)
    found = module.known_days(ids, "marts_index.event_days")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "fact_traffic" not in plan and "id_bucket" in plan[plan.index("PartitionFilters") :]
    assert {(r.event_id, r.day) for r in found.collect()} == {(r.event_id, r.day) for r in ids.collect()}
    again = at("03", "01:15", sent="2026-07-03T09:00:00.000+05:30") | {"event_id": at("01", "01:15")["event_id"]}
    assert {date(2026, 7, 1), date(2026, 7, 3)} <= set(job.cycle("b.json", again))
    assert job.table("event_days").count() == 21


def test_broken_files_and_lost_values_are_in_the_ledger(spark, tmp_path):
    job = Job(spark, tmp_path, "marts_ledger")
    job.cycle("a.json", at("01", "02:15"), at("01", "03:15"))
    assert load_errors(spark, job.warehouse, "raw").count() == 0
    outside = str(tmp_path / "outside")
    rows = spark.read.parquet(f"{job.lake}/raw").drop("event_date")
    rows.withColumn("event_ts", F.lit(None).cast("timestamp")).coalesce(1).write.parquet(outside)
    assert refresh(spark, job.lake, job.warehouse, layer=job.layer) == []
    assert ledger.load(spark, outside, RAW_SCHEMA, f"{job.warehouse}/x", RAW_SCHEMA, f"{job.warehouse}/ledger/x") == 1
    (tmp_path / "outside" / "part-zz.parquet").write_bytes(b"no parquet at all")
    assert ledger.load(spark, outside, RAW_SCHEMA, f"{job.warehouse}/x", RAW_SCHEMA, f"{job.warehouse}/ledger/x") == 2
    assert ledger.load(spark, outside, RAW_SCHEMA, f"{job.warehouse}/x", RAW_SCHEMA, f"{job.warehouse}/ledger/x") is None
    assert [(r.load_id, r.reason) for r in load_errors(spark, job.warehouse, "x").collect()] == [(2, "unreadable")]


def test_built_loads_are_compacted_and_nothing_changes(spark, tmp_path):
    job = Job(spark, tmp_path, "marts_compact")
    for k in range(1, 4):
        job.cycle(f"{k}.json", at("01", f"0{k}:15"), at("02", f"0{k}:15"))
    columns = RAW_SCHEMA.names

    def rows():
        return sorted(map(repr, loaded(spark, job.warehouse, "raw").select(*columns).collect()))

    before = rows()
    assert compact(spark, job.warehouse, job.layer)["raw"] == -1 and rows() == before
    assert sorted(p.name for p in (tmp_path / "warehouse" / "raw").glob("load_id=*")) == ["load_id=-1"]
    assert compact(spark, job.warehouse, job.layer)["raw"] is None
    assert job.cycle() == []
    assert date(2026, 7, 1) in job.cycle("4.json", at("01", "04:15"))
    assert compact(spark, job.warehouse, job.layer)["raw"] == -2 and len(rows()) == 7
    assert job.table("fact_traffic_events").count() == 7


def test_a_load_that_failed_before_its_entry_is_repeated(spark, tmp_path, monkeypatch):
    source, target, path = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    schema = T.StructType.fromDDL("a int, b string")
    spark.createDataFrame([(1, "x"), (2, "y")], schema).write.parquet(source)
    whole = ledger._entries

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ledger, "_entries", stop)
    with pytest.raises(RuntimeError):
        ledger.load(spark, source, schema, target, schema, path)
    assert ledger.loaded(spark, target, schema, path, str(tmp_path / "c")).count() == 0
    monkeypatch.setattr(ledger, "_entries", whole)
    spark.createDataFrame([(3, "z")], schema).write.mode("append").parquet(source)
    assert ledger.load(spark, source, schema, target, schema, path) == 1
    assert sorted(r.a for r in ledger.loaded(spark, target, schema, path, str(tmp_path / "c")).collect()) == [1, 2, 3]


def test_a_file_that_breaks_half_way_is_partly_read(spark, tmp_path):
    source, target, path = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    given, wanted = T.StructType.fromDDL("a long, b string"), T.StructType.fromDDL("a long, b int")
    rows = spark.range(60_000).selectExpr("id AS a", "CASE WHEN id % 10000 = 7 THEN 'no number' ELSE CAST(id AS STRING) END AS b")
    rows.coalesce(1).write.option("parquet.block.size", 65536).parquet(source)
    (sound,) = (tmp_path / "in").glob("*.parquet")
    data = bytearray(sound.read_bytes())
    third = len(data) // 3
    data[third : 2 * third] = b"\xff" * third
    (tmp_path / "in" / "part-broken.parquet").write_bytes(bytes(data))
    assert ledger.load(spark, source, given, target, wanted, path) == 1
    states = {r.file.rsplit("/", 1)[1]: r for r in ledger.ledger(spark, path).collect()}
    assert states[sound.name].state == ledger.LOADED and states[sound.name].rows == 60_000
    assert states[sound.name].lost == {"b": 6}
    broken = states["part-broken.parquet"]
    assert broken.state in (ledger.PARTLY, ledger.UNREADABLE) and broken.rows < 60_000
    assert ledger.loaded(spark, target, wanted, path, str(tmp_path / "c")).count() == 60_000 + broken.rows


def test_staged_tables_can_be_dropped(spark):
    from roadflow.session import drop_staged, staged

    path = staged(spark.range(3), "numbers").inputFiles()[0]
    assert drop_staged(spark) >= 1 and drop_staged(spark) == 0
    from pathlib import Path
    from urllib.parse import urlparse

    assert not Path(urlparse(path).path).exists()
