import random
from datetime import datetime

from pyspark.sql import functions as F

from wire_records import event
from roadflow.functions import fixed
from roadflow.operators import dedup, joins, quality, records, reports, sequences, sets, spells, windows
from roadflow.sources.contract import EVENT_SCHEMA

JULY = "2026-07-01 "


def clock(hour, minute=0, second=0):
    return datetime(2026, 7, 1, hour, minute, second)


def wire(spark, *rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_json_with_bare_nan_and_broken_text(spark):
    import json

    good = json.dumps(event(incident_type=float("nan"), latitude=float("nan")))
    raw = spark.createDataFrame([(bytearray(good, "utf8"),), (bytearray(b"not json"),), (bytearray(b'{"a":"\xff"}'),)], "value binary")
    readable, bad = records.split_dead_letters(raw)
    assert readable.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["not_json", "not_utf8"]
    row = records.with_missing_markers_removed(records.flatten_json(readable, EVENT_SCHEMA), lenient=True).first()
    assert row.incident_type is None and row.latitude is None and row.incident_duration_minutes == 0
    assert row.anomaly_type == "None"


def test_cleaning_and_rejects(spark):
    rows = [
        event(),
        event(event_timestamp="bad"),
        event(congestion_level="Moderate"),
        event(occupancy_pct=None),
        event(occupancy_pct=0.0),
        event(occupancy_pct=100.0),
        event(occupancy_pct=100.5, vehicle_count=-1),
        event(area=None),
    ]
    timed = records.with_event_time(wire(spark, *rows))
    assert records.clean(timed).count() == 3
    reasons = sorted(r.reasons for r in records.rejected(timed).collect())
    assert reasons == [
        "area_missing",
        "event_ts_missing",
        "occupancy_out_of_range",
        "unknown_level",
        "vehicle_count_negative,occupancy_out_of_range",
    ]
    assert records.clean(timed, aliases={"Moderate": "Medium"}).filter("congestion_level = 'Medium'").count() == 1
    assert records.raw_projection(timed).columns[1:3] == ["event_timestamp", "event_ts"]


SMALL = "event_id string, generated_at timestamp_ntz, event_ts timestamp_ntz, n int"


def test_dedup_keeps_first_or_latest_and_settles_ties(make):
    rows = [
        ("a", JULY + "08:00:10", JULY + "08:00:00", 1),
        ("a", JULY + "08:00:20", JULY + "08:00:00", 2),
        ("b", JULY + "08:00:10", JULY + "08:00:00", 3),
        ("b", JULY + "08:00:10", JULY + "08:00:00", 4),
        ("c", None, JULY + "08:00:00", 5),
        ("c", JULY + "08:00:01", JULY + "08:00:00", 6),
        (None, JULY + "08:00:01", JULY + "08:00:00", 7),
    ]
    df = make(rows, SMALL)
    found = set()
    for partitions in (1, 3, 7):
        spread = df.repartition(partitions)
        latest = {r.event_id: r.n for r in dedup.keep_latest(spread).collect()}
        first = {r.event_id: r.n for r in dedup.keep_first(spread).collect()}
        found.add((latest.pop("b"), first.pop("b")))
        assert latest == {"a": 2, "c": 6} and first == {"a": 1, "c": 6}
    assert len(found) == 1 and set(found.pop()) <= {3, 4}


def test_copies_against_originals(make):
    rows = [
        ("a", JULY + "08:00:10", "None", 1),
        ("a", JULY + "08:00:20", "Duplicate", 1),
        ("b", JULY + "08:00:10", "None", None),
        ("b", JULY + "08:00:05", "Duplicate", 3),
        ("c", JULY + "08:00:10", "None", 1),
    ]
    df = make(rows, "event_id string, generated_at timestamp_ntz, anomaly_type string, n int")
    found = {r.event_id: (r.copies, r.originals, r.same_values, r.copies_later) for r in dedup.copies_against_originals(df, ["n"]).collect()}
    assert found == {"a": (1, 1, True, True), "b": (1, 1, False, False)}


METRIC = (
    "event_ts timestamp_ntz, area string, road_segment_id string, road_name string, vehicle_count int, "
    "avg_speed_kmph double, occupancy_pct double, congestion_level string"
)


def test_window_metrics_splits_on_missing_road_name(make):
    rows = [
        (JULY + "08:00:00", "A", "S", "Road", 10, 20.0, 5.0, "Low"),
        (JULY + "08:04:59", "A", "S", "Road", 11, 30.0, 5.5, "Severe"),
        (JULY + "08:04:59", "A", "S", None, 13, 30.0, 5.5, "High"),
        (JULY + "08:05:00", "A", "S", "Road", 1, 1.0, 1.0, "Medium"),
    ]
    df = make(rows, METRIC)
    found = windows.window_metrics(df, with_rank=True).orderBy("window_start", F.desc("road_name")).collect()
    assert [r.event_count for r in found] == [2, 1, 1]
    assert (found[0].avg_vehicle_count, found[0].avg_speed_kmph, found[0].avg_occupancy_pct) == (10.5, 25.0, 5.25)
    assert [r.peak_congestion_level for r in found] == ["Severe", "High", "Medium"]
    assert found[0].window_end == clock(8, 5)
    assert windows.window_metrics(df).columns == fixed.METRIC_COLUMNS
    assert windows.window_metrics(df, ["area", "road_segment_id"]).count() == 2


def test_weather_spells_overlap(make):
    rows = [("A", JULY + "08:00:00", JULY + "08:03:00", "Cloudy"), ("A", JULY + "08:01:30", JULY + "08:02:30", "Rain")]
    spells = make(rows, "area string, start_ts timestamp_ntz, end_ts timestamp_ntz, weather string")
    found = windows.spells_to_timeline(spells).orderBy("minute").collect()
    assert [(r.minute.minute, r.area_weather) for r in found] == [(0, "Cloudy"), (1, "Rain"), (2, "Rain")]


STEP = "road_segment_id string, event_ts timestamp_ntz, generated_at timestamp_ntz, incident_type string"


def steps(make, *rows):
    return make([(s, t, g, i) for s, t, g, i in rows], STEP)


def test_gaps_cross_days_and_copies_count_once(make):
    df = steps(
        make,
        ("S", "2026-07-01 23:59:00", None, "None"),
        ("S", "2026-07-01 23:59:00", None, "None"),
        ("S", "2026-07-02 00:01:00", None, "None"),
        ("S", "2026-07-05 00:01:00", None, "None"),
        ("T", "2026-07-05 00:00:00", None, "None"),
    )
    found = sequences.observation_gaps(df).orderBy("road_segment_id", "event_ts").collect()
    assert [(r.observations, r.gap_seconds) for r in found] == [(2, None), (1, 120.0), (1, 3 * 86400.0), (1, None)]


def test_inversions(make):
    df = steps(
        make,
        ("S", "2026-07-01 08:00:00", "2026-07-01 08:01:00", "None"),
        ("S", "2026-07-01 08:05:00", "2026-07-01 08:06:00", "None"),
        ("S", "2026-07-01 08:02:00", "2026-07-02 09:00:00", "None"),
        ("S", "2026-07-01 08:03:00", "2026-07-02 09:00:00", "None"),
    )
    row = sequences.order_inversions(df).first()
    assert (row.observations, row.inversions) == (4, 1)


def test_episodes_join_over_midnight(make):
    df = steps(
        make,
        ("S", "2026-07-01 23:58:00", None, "Accident"),
        ("S", "2026-07-01 23:59:00", None, "Accident"),
        ("S", "2026-07-02 00:00:00", None, "Accident"),
        ("S", "2026-07-02 00:01:00", None, "None"),
        ("S", "2026-07-04 00:00:00", None, "None"),
        ("S", "2026-07-04 00:01:00", None, None),
        ("S", "2026-07-04 00:02:00", None, None),
        ("S", "2026-07-05 00:02:00", None, "Accident"),
    )
    found = sequences.episodes(df, ["incident_type"]).orderBy("episode").collect()
    assert [(r.episode, r.incident_type, r.observations) for r in found] == [
        (1, "Accident", 3),
        (2, "None", 2),
        (3, None, 2),
        (4, "Accident", 1),
    ]
    assert found[0].start_ts == datetime(2026, 7, 1, 23, 58) and found[0].end_ts == datetime(2026, 7, 2)


def test_missing_observations_cover_the_whole_run(make):
    df = steps(
        make,
        ("S", "2026-07-01 08:00:20", None, None),
        ("S", "2026-07-01 08:15:00", None, None),
        ("T", "2026-07-01 08:05:00", None, None),
    )
    found = sorted((r.road_segment_id, r.step.minute) for r in sequences.missing_observations(df, 5).collect())
    assert found == [("S", 5), ("S", 10), ("T", 0), ("T", 10), ("T", 15)]
    assert sequences.missing_observations(df.filter("road_segment_id = 'X'"), 5).count() == 0


def test_arrival_order_is_stable_and_whole(make):
    rows = [(f"e{i % 7}", JULY + f"08:{i % 60:02d}:00", JULY + "08:00:00", i) for i in range(200)]
    df = make(rows, SMALL).repartition(5)
    found = sequences.arrival_order(df).collect()
    assert len(found) == 200 and [r.generated_at for r in found] == sorted(r.generated_at for r in found)
    first = sequences.first_arrivals(df, 13).collect()
    assert [r.generated_at for r in first] == [r.generated_at for r in found[:13]]


def test_cumulative_share(make):
    rows = [("A", JULY + "01:10:00", 1), ("A", JULY + "02:10:00", 3), ("A", JULY + "01:50:00", 4), ("B", JULY + "05:00:00", 0)]
    df = make(rows, "area string, event_ts timestamp_ntz, vehicle_count int")
    found = sequences.cumulative_volume(df).orderBy("area", "hour").collect()
    assert [(r.running_vehicles, r.day_share) for r in found] == [(5, 0.625), (8, 1.0), (0, None)]


def test_incident_join_over_hours_and_phases(make):
    incidents = make(
        [("S", "i1", "Accident", JULY + "08:50:00", 40), ("T", "i2", "Road_Closure", JULY + "08:50:00", 20)],
        "road_segment_id string, incident_id string, active_incident string, start_ts timestamp_ntz, incident_duration_minutes int",
    )
    incidents = joins.incident_windows(incidents.withColumn("incident_type", F.col("active_incident"))).drop("incident_type")
    times = ["08:49:59", "08:50:00", "09:29:59", "09:30:00", "09:40:00", "09:50:00"]
    events = make([("S", JULY + t) for t in times] + [("T", JULY + "09:15:00")], "road_segment_id string, event_ts timestamp_ntz")
    found = joins.incident_phase(joins.incident_matches(events, incidents)).orderBy("road_segment_id", "event_ts").collect()
    assert [(r.event_ts.strftime("%H:%M:%S"), r.phase) for r in found] == [
        ("08:50:00", "active"),
        ("09:29:59", "active"),
        ("09:30:00", "recovery"),
        ("09:40:00", "recovery"),
        ("09:15:00", "recovery"),
    ]
    assert [round(r.capacity_factor, 4) for r in found] == [0.45, 0.45, 0.45, 0.725, 0.65]


def test_profile_wraps_over_midnight(make, spark):
    hourly = [float(h) for h in range(24)]
    profiles = spark.createDataFrame([("A", "weekday", hourly), ("A", "weekend", [9.0] * 24)], "area string, day_kind string, hourly array<double>")
    events = make([("A", JULY + t) for t in ("00:00:00", "00:30:00", "12:00:00", "23:45:00")], "area string, event_ts timestamp_ntz")
    found = [r.profile for r in joins.with_profile(events, profiles).orderBy("event_ts").collect()]
    assert found == [11.5, 0.0, 11.5, 23.0 - 23.0 * 0.25]


def test_orphans_semi_and_sets(make):
    a, b = make([("x",), ("y",), (None,), ("x",)], "k string"), make([("y",), ("z",)], "k string")
    assert sorted(tuple(r) for r in joins.orphan_keys(a, b, "k").collect()) == [("x", "fact"), ("z", "dimension")]
    assert joins.rows_in_set(a, b, "k").count() == 1
    assert tuple(sets.compare_sets(a.dropna(), b, ["k"]).first()) == (1, 1, False)
    assert tuple(sets.compare_sets(a, a.distinct(), ["k"]).first()) == (0, 0, True)
    assert sets.only_in_first(a.dropna(), b, ["k"]).collect()[0].k == "x"
    assert sets.union_all({"a": a, "b": b.withColumn("m", F.lit(1))}).filter("source = 'a' AND m IS NULL").count() == 4


def test_star_join_keeps_unknown_keys_and_prefixes_clashes(make):
    fact = make([("r", "A", 1), (None, "B", 2), ("q", "C", 3)], "weather_key string, area string, n int")
    dim = joins.one_per_key(make([("r", "rain", "x"), ("r", "Rain", "x")], "weather_key string, weather string, area string"), "weather_key")
    found = joins.star_join(fact, {"weather_key": dim}).orderBy("n").collect()
    assert [(r.n, r.weather, r.weather_key_area) for r in found] == [(1, "Rain", "x"), (2, None, None), (3, None, None)]


def test_faults_are_disjoint_labelled_and_repeatable(spark):
    from roadflow.registry.observations import observations

    base = dedup.keep_latest(observations(spark, "/root/testdata/sf0.001")).withColumn("anomaly_type", F.lit("None"))
    faulty = quality.inject_faults(base, 3, delayed_pct=10, missing_pct=10, invalid_pct=10, duplicate_pct=10)
    counts = {r.anomaly_type: r["count"] for r in faulty.groupBy("anomaly_type").count().collect()}
    n = base.count()
    assert all(0.05 * n < counts[k] < 0.15 * n for k in fixed.ANOMALIES[1:])
    assert faulty.count() == n + counts["Duplicate"]
    assert faulty.exceptAll(quality.inject_faults(base.repartition(9), 3, 10, 10, 10, 10)).count() == 0
    pairs = dedup.copies_against_originals(faulty, [c for c in faulty.columns if c not in ("event_id", "generated_at", "anomaly_type")])
    assert pairs.filter("NOT same_values OR NOT copies_later OR copies <> 1 OR originals <> 1").count() == 0
    found = quality.detect_anomalies(faulty)
    assert found.filter("anomaly_type = 'Duplicate' AND NOT contains(detected, 'Duplicate')").count() == 0
    assert found.filter("anomaly_type = 'Missing_Field' AND NOT contains(detected, 'Missing_Field')").count() == 0
    assert found.filter("anomaly_type = 'Invalid_Value' AND NOT contains(detected, 'Invalid_Value')").count() == 0
    assert found.filter("anomaly_type = 'Delayed' AND NOT contains(detected, 'Delayed')").count() == 0


def test_impact_and_shares(make):
    rows = [("Clear", 40.0, 10), ("Clear", 50.0, 20), ("Rain", 30.0, 5), (None, 20.0, 1)]
    df = make(rows, "weather string, avg_speed_kmph double, vehicle_count int")
    found = {r.weather: (r.avg_speed_kmph, r.avg_vehicle_count, r.speed_vs_base) for r in reports.weather_impact(df).collect()}
    assert found == {"Clear": (45.0, 15.0, 1.0), "Rain": (30.0, 5.0, 0.6667), None: (20.0, 1.0, 0.4444)}
    rates = {r.weather: r.rate for r in quality.anomaly_rates(df, "weather").collect()}
    assert rates == {"Clear": 0.5, "Rain": 0.25, None: 0.25}


def test_dimension_problems(spark, make):
    import pytest

    good = ("WFD-001", "WFD", "Whitefield", "R", 12.9, 77.5, "Local", 2, 30, 16.0, 0.9, 1.0)
    schema = (
        "road_segment_id string, area_id string, area string, road_name string, latitude double, longitude double, road_type string, "
        "lane_count int, speed_limit_kmph int, capacity_vehicles_per_minute double, free_flow_ratio double, base_demand_factor double"
    )
    segments = make([good, good, ("WFD-002", "WFD", "Nowhere", "R", 0.0, 77.5, "Track", 1, 30, 16.0, 1.5, 1.0)], schema)
    profiles = spark.createDataFrame([("tech", "weekday", [1.0] * 24), ("tech", "weekend", [1.0] * 23), ("x", "weekend", None)], "area_type string, day_kind string, hourly array<double>")
    found = sorted(tuple(r) for r in quality.dimension_problems(segments, profiles, (10, 20)).collect())
    assert found == [
        ("WFD", "area_size"),
        ("WFD-001", "repeated_id"),
        ("WFD-002", "free_flow_ratio"),
        ("WFD-002", "lane_count"),
        ("WFD-002", "latitude"),
        ("WFD-002", "road_type"),
        ("WFD-002", "unknown_area"),
        ("tech/weekend", "profile_length"),
        ("x/weekend", "profile_length"),
    ]
    with pytest.raises(ValueError):
        quality.dimension_problems(segments.drop("lane_count"))


def test_one_incident_is_one_interval(make):
    def minute(m):
        return f"2026-07-01 {8 + m // 60:02d}:{m % 60:02d}:00"

    rows = [(f"A-{m}", "A", minute(m), "Accident", 40) for m in range(40)]
    rows += [(f"A-{m}", "A", minute(m), "None", 0) for m in range(40, 60)]
    rows += [(f"B-{m}", "B", minute(m), "Roadwork", 10) for m in range(5)]
    rows += [(f"B-{m}", "B", minute(m), "Road_Closure", 5) for m in range(5, 10)]
    events = make(
        rows,
        "event_id string, road_segment_id string, event_ts timestamp_ntz, incident_type string, incident_duration_minutes int",
    )
    found = joins.incident_intervals(events)
    spans = {(r.road_segment_id, r.incident_type, str(r.start_ts), str(r.end_ts)) for r in found.collect()}
    assert spans == {
        ("A", "Accident", minute(0), minute(40)),
        ("B", "Roadwork", minute(0), minute(10)),
        ("B", "Road_Closure", minute(5), minute(10)),
    }
    named = found.withColumnsRenamed({"incident_type": "active_incident"}).drop("incident_duration_minutes")
    active = joins.incident_matches(events, named, end="end_ts").groupBy("road_segment_id").count().collect()
    assert {r.road_segment_id: r["count"] for r in active} == {"A": 40, "B": 15}
    least = {r.event_id: (r.incidents, r.capacity_factor) for r in joins.least_capacity(events, named).collect()}
    assert least["A-39"] == (1, 0.45) and least["B-3"] == (1, 0.6) and least["B-7"] == (2, 0.0)
    assert len(least) == 60 + 10 and 0.45 < least["A-50"][1] < least["A-59"][1] < 1


def test_unchanged_redeliveries_are_duplicates(spark):
    from roadflow.registry.observations import observations

    one = observations(spark, "/root/testdata/sf0.001").filter("anomaly_type = 'None'").limit(3)
    events = one.unionByName(one).unionByName(one.limit(1)).withColumn("latitude", F.lit(float("nan")))
    found = quality.detect_anomalies(events)
    assert sorted(found.columns) == sorted([*events.columns, "detected"])
    counts = found.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("detected").contains("Duplicate"), 1)).alias("again")
    )
    rows = counts.collect()
    assert sum(r.n for r in rows) == 7 and all(r.again == r.n - 1 for r in rows) and len(rows) == 3
    assert found.filter("detected NOT LIKE '%Missing_Field%'").count() == 0


def test_buckets_follow_the_length_of_the_incidents(make):
    minute = "2026-07-{:02d} {:02d}:{:02d}:00".format
    intervals = [("A", minute(1, h, 7), minute(1, h, 12), f"short{h}") for h in range(20)]
    intervals += [("A", minute(2, 0, 0), minute(30, 0, 0), "long"), ("A", minute(1, 3, 0), minute(1, 3, 0), "none")]
    events = [("A", minute(d, h, m)) for d in (1, 2, 29, 30) for h in (0, 3, 19, 23) for m in (0, 7, 11, 12, 59)]
    for kind in ("timestamp_ntz", "timestamp"):
        seen = make(events, f"road_segment_id string, event_ts {kind}")
        incidents = make(intervals, f"road_segment_id string, start_ts {kind}, end_ts {kind}, incident_id string")
        width = joins.interval_width(incidents, end="end_ts")
        assert width == -(-(20 * 300 + 28 * 86400) // 21)
        wanted = {(e, i[3]) for _, e in events for i in intervals if i[1] <= e < i[2]}
        for seconds in (None, 60, 7 * 86400 + 1):
            found = joins.incident_matches(seen, incidents, end="end_ts", bucket_seconds=seconds).collect()
            assert {(str(r.event_ts), r.incident_id) for r in found} == wanted and len(found) == len(wanted)
    assert joins.interval_width(incidents.limit(0), end="end_ts") == 3600
    assert joins.incident_matches(seen, incidents.limit(0), end="end_ts").count() == 0


def test_flattened_spells_are_the_minute_timeline(make):
    rng = random.Random(5)
    day = "2026-07-{:02d} {:02d}:{:02d}:00".format
    rows = []
    for _ in range(150):
        at = rng.randrange(6 * 1440)
        until = at + rng.choice([0, 1, 30, 200, 2000])
        stamps = [day(1 + m // 1440, m % 1440 // 60, m % 60) for m in (at, until)]
        rows.append((rng.choice("ABC"), *stamps, rng.choice([*fixed.WEATHER, "rain", "Odd", None])))
    rows += rows[:20] + [(None, day(1, 0, 0), day(2, 0, 0), "Rain"), ("D", day(1, 0, 0), day(29, 0, 0), "Clear")]
    rows += [("D", day(3, 0, 0), day(3, 0, 1), "Rain"), ("E", day(1, 0, 0), None, "Rain"), ("E", day(2, 0, 0), day(1, 0, 0), "Rain")]
    given = make(rows, "area string, start_ts timestamp_ntz, end_ts timestamp_ntz, weather string")
    grid = windows.spells_to_timeline(given.filter("area IS NOT NULL"))
    wanted = {(r.area, str(r.minute), r.area_weather) for r in grid.collect()}
    for chunk in ("DAY", "HOUR"):
        flat = spells.flatten_spells(given, chunk=chunk).withColumn("weather", F.col("area_weather"))
        found = flat.orderBy("area", "start_ts").collect()
        assert {(r.area, str(r.minute), r.area_weather) for r in windows.spells_to_timeline(flat).collect()} == wanted
        for a, b in zip(found, found[1:]):
            if a.area == b.area:
                assert a.end_ts < b.start_ts or (a.end_ts == b.start_ts and a.weather_rank != b.weather_rank)
        assert [r.area_weather for r in found if r.area == "D"] == ["Clear", "Rain", "Clear"]
    assert spells.flatten_spells(given.limit(0)).count() == 0
