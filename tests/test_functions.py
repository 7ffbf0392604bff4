from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadflow.functions import congestion, labels, measures, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "score,level",
    [(0, "Low"), (24.9, "Low"), (25, "Moderate"), (44.9, "Moderate"), (45, "High"), (64.9, "High"), (65, "Severe"), (100, "Severe")],
)
def test_level_thresholds(spark, score, level):
    assert one(spark, congestion.level_of_score(F.lit(float(score)))) == level


def test_level_of_closed_road_and_of_unknown_score(spark):
    assert one(spark, congestion.level_of_score(F.lit(1.0), F.lit(True))) == "Severe"
    assert one(spark, congestion.level_of_score(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("speed,limit,occupancy,score", [(50, 50, 0, 0), (0, 50, 100, 100), (25, 50, 40, 45), (80, 50, 0, 0)])
def test_score(spark, speed, limit, occupancy, score):
    value = congestion.congestion_score(F.lit(float(speed)), F.lit(float(limit)), F.lit(float(occupancy)))
    assert one(spark, value) == pytest.approx(score)


def test_occupancy(spark):
    moving = congestion.occupancy_of_flow(F.lit(20), F.lit(40.0), F.lit(4), 60)
    assert one(spark, moving) == pytest.approx(4.9)
    assert one(spark, congestion.occupancy_of_flow(F.lit(20), F.lit(0.0), F.lit(4), 60)) == 0
    assert one(spark, congestion.occupancy_of_flow(F.lit(9000), F.lit(3.0), F.lit(1), 60)) == 98


def model_speed(spark, demand, weather="Clear", factor=1.0):
    capacity = congestion.effective_capacity(F.lit(60.0), F.lit(weather), F.lit(factor), 60)
    load = congestion.saturation(F.lit(demand * 60.0), capacity)
    return one(spark, congestion.expected_speed(F.lit(50.0), F.lit(0.9), F.lit(weather), load))


def test_more_demand_is_slower(spark):
    speeds = [model_speed(spark, d) for d in (0.2, 0.6, 1.0, 1.5)]
    assert speeds == sorted(speeds, reverse=True) and len(set(speeds)) == 4


def test_rain_and_incidents_are_slower(spark):
    clear, rain, heavy = (model_speed(spark, 0.8, w) for w in ("Clear", "Rain", "Heavy_Rain"))
    assert clear > rain > heavy
    assert model_speed(spark, 0.8, factor=0.45) < clear


def test_speed_stays_between_crawl_and_limit(spark):
    assert model_speed(spark, 50.0) == 3.0
    assert model_speed(spark, 0.0) == 45.0


def test_throughput_drops_above_capacity(spark):
    through = [one(spark, congestion.throughput(F.lit(float(d)), F.lit(60.0))) for d in (30, 60, 90, 120, 500)]
    assert through == pytest.approx([30, 60, 55.5, 51, 51])


def test_closed_road_has_no_readings(spark):
    assert one(spark, congestion.unless_closed(F.lit(True), F.lit(7.0))) == 0
    assert one(spark, congestion.unless_closed(F.lit(False), F.lit(7.0))) == 7


def test_recovery(spark):
    ramp = [one(spark, congestion.recovery_capacity(F.lit(0.0), F.lit(float(s)), F.lit(100.0))) for s in (0, 50, 100)]
    assert ramp == pytest.approx([0.3, 0.65, 1.0])
    assert one(spark, congestion.recovery_minutes(F.lit("Accident"), F.lit(40))) == 20
    assert one(spark, congestion.recovery_minutes(F.lit("Roadwork"), F.lit(480))) == 60
    assert one(spark, congestion.recovery_minutes(F.lit("Vehicle_Breakdown"), F.lit(12))) == 10


def test_event_time_forms(spark):
    local = datetime(2026, 7, 1, 0, 0)
    for text in ("2026-07-01T00:00:00", "2026-06-30T18:30:00+00:00", "2026-07-01T00:00:00+05:30", " 2026-06-30T18:30:00Z "):
        assert one(spark, times.local_event_time(F.lit(text))) == local
    assert one(spark, times.local_event_time(F.lit("bad"))) is None


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        local = times.local_event_time(F.lit("2026-06-30T20:45:00+00:00"))
        assert one(spark, times.date_key(F.to_date(local))) == 20260701
        assert one(spark, times.iso_seconds(local)) == "2026-07-01T02:15:00+05:30"
        assert one(spark, times.floor_time(local, 60)) == datetime(2026, 7, 1, 2)
        assert one(spark, times.event_key(F.lit("WFD-001"), local)) == "WFD-001_20260701T021500"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    saturday = F.lit("2026-07-04 13:05:00").cast("timestamp_ntz")
    row = spark.range(1).select(*[v.alias(c) for c, v in times.calendar_columns(saturday).items()]).first()
    assert row.asDict() == {
        "is_weekend": True,
        "hour_of_day": 13,
        "day_of_week": "Saturday",
        "year": "2026",
        "month": "07",
        "day": "04",
    }
    assert one(spark, times.iso_weekday(saturday)) == 6


def test_floor_keeps_micros_out(spark):
    ts = F.lit("2026-07-04 13:07:59.999999").cast("timestamp_ntz")
    assert one(spark, times.floor_time(ts, 5)) == datetime(2026, 7, 4, 13, 5)
    assert one(spark, times.floor_second(ts)) == datetime(2026, 7, 4, 13, 7, 59)
    with pytest.raises(ValueError):
        times.floor_time(ts, 7)


def test_labels(spark):
    assert one(spark, labels.canonical_label(F.lit(" SEVERE "))) == "Severe"
    assert one(spark, labels.canonical_label(F.lit(" Moderate "))) == "Moderate"
    assert one(spark, labels.canonical_label(F.lit("moderate"), aliases={"Moderate": "Medium"})) == "Medium"
    assert one(spark, labels.canonical_label(F.lit("  "))) is None
    assert one(spark, labels.label_rank(F.lit("mEdium "))) == 2
    assert one(spark, labels.label_rank(F.lit("Moderate"))) is None
    assert one(spark, labels.rank_label(F.lit(4))) == "Severe"
    assert one(spark, labels.rank_label(F.lit(5))) is None


def test_markers(spark):
    for text in ("nan", "Nan", ""):
        assert one(spark, labels.marker_to_null(F.lit(text))) is None
    assert one(spark, labels.marker_to_null(F.lit('"NaN"'))) == '"NaN"'
    for text in ('"NaN"', "NAN", " nan ", ""):
        assert one(spark, labels.marker_to_null(F.lit(text), lenient=True)) is None
    assert one(spark, labels.marker_to_null(F.lit("None"), lenient=True)) == "None"
    assert one(spark, labels.number_or_null(F.lit(float("nan")))) is None


def test_surrogate_key(spark):
    keys = {one(spark, labels.surrogate_key(F.lit(t))) for t in ("Rain", "rain", " Rain ")}
    assert len(keys) == 1 and len(keys.pop()) == 32
    assert one(spark, labels.surrogate_key(F.lit(None).cast("string"))) is None


def test_exact_mean(spark):
    rows = spark.createDataFrame([(2.67,), (2.68,)], "x double")
    assert rows.agg(measures.mean("x", 2, 2)).first()[0] == 2.68
    signed = spark.createDataFrame([(-2.67,), (-2.68,)], "x double")
    assert signed.agg(measures.mean("x", 2, 2)).first()[0] == -2.68
    assert rows.filter("x > 9").agg(measures.mean("x", 2, 2)).first()[0] is None
    assert rows.agg(measures.mean("x")).first()[0] in (2.67, 2.68)
    with pytest.raises(ValueError):
        measures.mean("x", 1, 2)
