import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wire_records import event
from roadflow.functions import fixed
from roadflow.sources import contract, files, tables
from roadflow.sources.contract import EVENT_SCHEMA, Field, event_contract


def wire(spark, *rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def raw(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")


def codes(spark, *texts):
    found = event_contract().json_violations(raw(spark, *texts))
    return [r.violations for r in found.collect()]


def test_valid_records_pass(spark):
    missing = event(anomaly_type="Missing_Field", road_name=None, latitude=None, occupancy_pct=None, weather=None, incident_duration_minutes=None)
    assert event_contract().violations(wire(spark, event(), missing)).count() == 0
    assert codes(spark, event(), missing, event(vehicle_count=7.0)) == ["", "", ""]


def test_typed_violations(spark):
    rows = [
        event(event_id="x", latitude=0.0),
        event(vehicle_count=-1, congestion_level="Medium"),
        event(incident_type=None, generated_at="later", data_source="else"),
    ]
    found = [r.violations for r in event_contract().violations(wire(spark, *rows)).collect()]
    assert found == [
        "pattern:event_id,minimum:latitude,key:event_id",
        "minimum:vehicle_count,enum:congestion_level",
        "null:incident_type,const:data_source,format:generated_at",
    ]


def test_times_and_key_agree(spark):
    late = event(generated_at="2026-07-01T08:14:00.000+05:30")
    rows = [
        event(generated_at="2026-07-01T02:46:01.500+00:00"),
        event(event_timestamp="2026-07-01T08:15:00"),
        late,
        event(event_id="WFD-002_20260701T081500"),
        event(event_id="WFD-001_20260702T081500"),
        event(event_timestamp="bad"),
    ]
    wanted = ["offset:generated_at", "offset:event_timestamp", "order:generated_at", "key:event_id", "key:event_id", "format:event_timestamp"]
    assert [r.violations for r in event_contract().violations(wire(spark, *rows)).collect()] == wanted
    assert codes(spark, *rows) == wanted


def test_load_errors_name_skipped_files_and_lost_values(spark, tmp_path):
    source = str(tmp_path / "source")
    schema = T.StructType.fromDDL("id string, n string, kept int")
    wanted = T.StructType.fromDDL("id string, total bigint, kept int")
    rows = [("a", "1", 1), ("b", "x", 2), ("c", None, 3), ("d", "y", 4)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    Path(source, "part-broken.parquet").write_bytes(b"no parquet")
    found = tables.load_errors(spark, source, schema, wanted, renames={"n": "total"}).collect()
    assert sorted((r.file.rsplit("/", 1)[1][:11], r.field, r.n, r.reason) for r in found) == [
        ("part-00000-", "total", 2, "value does not fit"),
        ("part-broken", None, None, "unreadable or empty"),
    ]


def test_whole_publish_drops_vanished_partitions(spark):
    df = spark.createDataFrame([(1, 20260701), (2, 20260702)], "n int, date_key int")
    tables.publish(df, "numbers_whole", "marts", partition_by=["date_key"], whole=True)
    tables.publish(df.filter("n = 2"), "numbers_whole", "marts", partition_by=["date_key"], whole=True)
    assert [tuple(r) for r in tables.source_table(spark, "marts", "numbers_whole").collect()] == [(2, 20260702)]


def test_json_violations(spark):
    absent = event()
    del absent["area"]
    found = codes(
        spark,
        absent,
        event(extra=1),
        event(vehicle_count="10", is_weekend="no", latitude="12.9"),
        event(vehicle_count=1.5),
        event(area=None, weather=None),
        event(hour_of_day=24, occupancy_pct=101),
        "not json",
        "[1]",
    )
    assert found == [
        "missing:area",
        "undeclared",
        "type:latitude,type:vehicle_count,type:is_weekend",
        "type:vehicle_count",
        "null:area",
        "maximum:occupancy_pct,maximum:hour_of_day",
        "not_an_object",
        "not_an_object",
    ]


def test_conform(spark):
    row = {"zeta": 1, "area": "Whitefield", "alpha": None, "vehicle_count": 3}
    found = event_contract().conform(raw(spark, row)).first()
    assert list(found.asDict()) == [*fixed.EVENT_COLUMNS, "undeclared"]
    assert (found.area, found.vehicle_count, found.weather, found.undeclared) == ("Whitefield", 3, None, "alpha,zeta")


def test_contract_from_schema_file(spark, tmp_path):
    document = {
        "additionalProperties": False,
        "required": ["a", "b"],
        "properties": {
            "a": {"type": "string", "pattern": "^x"},
            "b": {"type": ["integer", "null"], "minimum": 0},
            "c": {"type": ["string", "null"], "enum": ["u", None]},
        },
        "x-partitioning": {"parquet": ["c"]},
    }
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(document, indent=1))
    read = contract.read_contract(spark, str(path))
    assert read.names == ["a", "b", "c"] and read.closed and read.partitioning == ("c",)
    assert read.schema() == T.StructType.fromDDL("a string, b int, c string")
    found = read.json_violations(raw(spark, {"a": "x", "b": None}, {"a": "y", "b": -1, "c": "v"}, {"a": 1, "d": 2}))
    assert [r.violations for r in found.collect()] == ["", "pattern:a,minimum:b,enum:c", "type:a,missing:b,undeclared"]


def test_contract_fields_can_be_replaced(spark):
    renamed = contract.level_name_contract(event_contract(), {"Moderate": "Medium"})
    assert renamed.violations(wire(spark, event(congestion_level="Medium"))).count() == 0
    free = event_contract(area=Field("area"))
    assert free.violations(wire(spark, event(area="Anywhere"))).count() == 0


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_text_files_roll_and_refuse_to_overwrite(spark, tmp_path, kind):
    path = str(tmp_path / "events")
    rows = wire(spark, *[event(vehicle_count=i, road_name=None if i % 2 else "R") for i in range(10)]).coalesce(1)
    files.write_text_events(rows, path, kind, max_rows=4)
    assert len(list(Path(path).glob(f"part-*.{kind}"))) == 3
    read = files.read_csv_events if kind == "csv" else files.read_json_events
    back = read(spark, path)
    assert back.schema == EVENT_SCHEMA
    assert back.filter("road_name IS NULL AND incident_type = 'None'").count() == 5
    assert back.exceptAll(rows).count() == 0 and back.count() == 10
    with pytest.raises(AnalysisException):
        files.write_text_events(rows, path, kind)
    files.write_text_events(rows.limit(1), path, kind, overwrite=True)
    assert read(spark, path).count() == 1


def test_partitioned_files_keep_partition_text(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = wire(spark, event(), event(area="Electronic City"))
    parts = {"year": F.lit("2026"), "month": F.lit("07"), "day": F.lit("01")}
    files.write_partitioned_events(rows.withColumns(parts), path)
    assert (Path(path) / "year=2026" / "month=07" / "day=01").is_dir()
    back = files.read_partitioned_events(spark, path)
    assert {(r.month, r.day, r.area) for r in back.collect()} == {("07", "01", "Whitefield"), ("07", "01", "Electronic City")}
    scan = back.filter("area = 'Whitefield' AND month = '07'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(area" in scan
    with pytest.raises(AnalysisException):
        files.write_partitioned_events(rows.withColumns(parts), path)


def test_keyed_json_writes_nulls(spark):
    row = files.keyed_json(wire(spark, event(weather=None))).first()
    record = json.loads(row.value)
    assert row.key == "WFD-001" and list(record) == fixed.EVENT_COLUMNS and record["weather"] is None


def test_city_configuration(spark, tmp_path):
    city = {
        "day_of_week_multiplier": {"Monday": 1.0, "Sunday": 0.9},
        "monthly_rain_spells_per_day": {"1": 0.05},
        "area_type_hourly_profiles": {"t": {"weekday": [0.1] * 24, "weekend": [0.2] * 24}},
        "areas": [{"area_id": "A", "area_name": "Alpha", "area_type": "t", "peak_demand_ratio": 1.2}],
    }
    path = tmp_path / "areas.json"
    path.write_text(json.dumps(city, indent=2))
    read = files.read_city(spark, str(path))
    assert files.city_areas(read).first().peak_demand_ratio == 1.2
    hours = files.profile_hours(files.city_profiles(read))
    assert hours.count() == 48 and hours.filter("day_kind = 'weekend' AND hour = 23").first().value == 0.2
    factors = files.city_factors(read, "day_of_week_multiplier", "day_name")
    assert {r.day_name: r.factor for r in factors.collect()} == {"Monday": 1.0, "Sunday": 0.9}
    files.write_metadata(files.city_areas(read), str(tmp_path / "meta"))
    assert spark.read.option("header", True).csv(str(tmp_path / "meta")).first().area_id == "A"


def test_load_new_files_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    schema = T.StructType.fromDDL("WINDOW_START timestamp, Event_Count string, other int")
    wanted = T.StructType.fromDDL("window_start timestamp, total_events bigint, missing string")

    def arrive(value):
        spark.createDataFrame([(None, value, 1)], schema).coalesce(1).write.mode("append").parquet(source)

    def load():
        return tables.load_new_files(spark, source, schema, target, wanted, checkpoint, renames={"event_count": "total_events"})

    arrive("5")
    assert load() == 1
    assert load() == 0
    arrive("x")
    Path(source, "part-broken.parquet").write_bytes(b"no parquet")
    assert load() == 1
    rows = spark.read.schema(wanted).parquet(target).collect()
    assert sorted((r.total_events for r in rows), key=str) == [5, None] and all(r.missing is None for r in rows)


def test_names_views_and_tables(spark):
    assert tables.layer_database(None) == "default" and tables.layer_database(" marts ") == "marts"
    df = spark.createDataFrame([(1, 20260701), (2, 20260702)], "n int, date_key int")
    assert tables.publish(df, "numbers", "staging", "view") == "staging_numbers"
    assert spark.table("staging_numbers").count() == 2
    tables.publish(df, "numbers", "marts", partition_by=["date_key"])
    tables.publish(df.filter("n = 2").withColumn("n", F.lit(9)), "numbers", "marts", partition_by=["date_key"])
    assert sorted(tuple(r) for r in tables.source_table(spark, "marts", "numbers").collect()) == [(1, 20260701), (9, 20260702)]
    with pytest.raises(ValueError):
        tables.publish(df, "numbers", "marts", "snapshot")
