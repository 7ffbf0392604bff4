import pytest
from pyspark.sql import functions as F

from roadflow.operators.dedup import keep_first
from roadflow.operators.records import clean
from roadflow.operators.windows import window_metrics
from roadflow.plans import build, marts, staging
from roadflow.registry.observations import observations
from roadflow.session import shared_folder, shuffle_width, staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    valid = clean(staging.stage_events(observations(spark, SF))).filter("hour_of_day <= 23")
    valid = valid.withColumn("incident_duration_minutes", F.greatest("incident_duration_minutes", F.lit(0)))
    return build.build(valid, window_metrics(keep_first(valid)))


def test_build_publishes_the_star_schema(spark, built):
    for name in ("dim_date", "dim_road_segment", "dim_weather", "dim_incident", "fact_traffic_events", "fact_traffic_5min"):
        assert spark.table(f"marts.{name}").count() > 0
    assert spark.table("marts.fact_traffic_events").count() == built.events.count()
    assert spark.table("intermediate_int_traffic_events_deduplicated").count() == built.events.count()
    assert "total_events" in spark.table("staging_stg_traffic_metrics_5min").columns


def test_facts_find_their_dimensions(built):
    star = built.star_events()
    assert star.count() == built.fact_events.count()
    assert star.filter("date_day IS NULL OR area IS NULL").count() == 0
    assert star.filter("weather_key IS NOT NULL AND weather IS NULL").count() == 0
    assert star.filter("weather_key IS NULL").count() > 0
    assert built.star_5min().count() == built.fact_5min.count()


def test_dimension_joins_are_broadcast_by_size_only(spark, built):
    plan = built.star_events()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 4
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        large = built.star_events()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == built.fact_events.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_build_stops_on_violations(spark):
    bad = observations(spark, SF)
    with pytest.raises(build.BuildError):
        build.build(bad, window_metrics(bad))


def test_label_spellings_share_a_key(make):
    events = make([("Rain",), (" Rain ",), ("rain",), ("",), (None,)], "weather string")
    rows = marts.dim_weather(events).collect()
    assert sorted(r.weather for r in rows) == ["Rain", "rain"] and len({r.weather_key for r in rows}) == 1


def test_dim_date_unites_both_sources(make):
    events = make([("2026-07-04 10:00:00",), (None,)], "event_ts timestamp_ntz")
    metrics = make([("2026-07-04 11:00:00",), ("2026-07-06 00:00:00",)], "window_start timestamp_ntz")
    rows = marts.dim_date(events, metrics).orderBy("date_key").collect()
    assert [(r.date_key, r.quarter, r.month_name, r.day_of_week, r.day_name, r.is_weekend) for r in rows] == [
        (20260704, 3, "Jul", 6, "Sat", True),
        (20260706, 3, "Jul", 1, "Mon", False),
    ]


def test_top_one_is_limited_before_the_shuffle(spark):
    plan = marts.latest_events(observations(spark, SF))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_staged_tables_lie_in_the_shared_folder(spark):
    assert shared_folder(spark).startswith(("file:", "/"))
    df = staged(spark.range(5), "numbers")
    assert df.count() == 5 and "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_width():
    assert shuffle_width(0.1) == 8 and shuffle_width(10 * 1024) == 40960


def test_no_python_runs_in_the_tasks(spark):
    from roadflow.registry import QUERIES

    for name in ("win5_agg", "contract_violations", "metric_model", "incident_episodes", "json_contract"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_stream_then_load_then_build(spark, tmp_path):
    import json

    from wire_records import event
    from roadflow.streaming import jobs

    def arrive(name, *records):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in records))

    def cycle():
        source = jobs.file_stream(spark, str(tmp_path / "in"))
        jobs.wait(spark, *jobs.run(source, str(tmp_path / "lake"), drain=True))
        return build.load_then_build(spark, str(tmp_path / "lake"), str(tmp_path / "warehouse"))

    def at(clock, **changes):
        stamp = f"2026-07-{clock}+05:30"
        key = f"WFD-001_202607{clock.replace(':', '').replace('-', '')}"
        return event(event_id=key, event_timestamp=stamp, generated_at=stamp.replace("+", ".000+"), **changes)

    arrive("a.json", at("01T02:15:00"), at("01T02:15:00", anomaly_type="Duplicate", weather=" "), at("01T06:00:00"))
    first = cycle()
    assert first.events.count() == 2 and first.fact_5min.count() == 1
    assert [r.date_key for r in first.dim_date.collect()] == [20260701]
    arrive("b.json", at("02T02:15:00"), at("02T06:00:00", vehicle_count=7))
    second = cycle()
    assert second.events.count() == 4 and second.fact_5min.count() == 3
    assert second.fact_5min.filter("total_events IS NULL OR peak_congestion_rank IS NULL").count() == 0
    assert second.star_5min().filter("date_day IS NULL").count() == 0
