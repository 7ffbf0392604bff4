"""Tables laid out by segment and day: the same results, and no reading exchanged along a segment."""

import re

import pytest
from pyspark.sql import functions as F

from roadflow.operators import sequences
from roadflow.plans import layout, marts

SCHEMA = (
    "event_id string, road_segment_id string, area string, road_name string, latitude double, longitude double, "
    "event_ts timestamp_ntz, generated_at timestamp_ntz, incident_type string"
)


def row(n, segment, at, sent=None, name="a", kind=None):
    return (f"e{n}", segment, "X", name, 1.0, None, at, sent or at, kind)


@pytest.fixture
def readings(make):
    hot = [
        row(n, "HOT", f"2026-07-0{1 + n // 24 % 5} {n % 24:02d}:00:00", name=f"r{n}", kind=["Accident", None][n // 7 % 2])
        for n in range(120)
    ]
    others = [row(200 + n, f"S{n}", "2026-07-03 08:00:00") for n in range(20)]
    odd = [
        row(300, "HOT", "2026-07-01 00:00:00"),
        row(300, "HOT", "2026-07-01 00:00:00"),
        row(301, None, "2026-07-01 00:00:00"),
        row(302, "LOST", None, "2026-07-09 00:00:00", name="timeless"),
        row(303, "LOST", "2026-07-01 00:00:00", "2026-07-02 00:00:00"),
        row(304, "", "2026-07-01 00:00:00"),
    ]
    return make(hot + others + odd, SCHEMA)


@pytest.fixture
def laid_out(spark, readings):
    full = layout.write_by_segment(readings, "readings", 4, "layout_test")
    yield full
    spark.sql("DROP DATABASE layout_test CASCADE")


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_results_are_those_of_the_plain_table(spark, readings, laid_out):
    same(layout.gaps(spark, laid_out), sequences.observation_gaps(readings))
    labels = ["incident_type"]
    same(layout.episodes(spark, laid_out, labels), sequences.episodes(readings, labels))
    same(layout.segment_latest(spark, laid_out), marts.dim_road_segment(readings))
    names = {r.road_segment_id: r.road_name for r in layout.segment_latest(spark, laid_out).collect()}
    assert names["LOST"] == "timeless" and names["HOT"] == "r119" and None not in names


def subtrees_of_exchanges(df):
    """Plan text below each exchange by hash."""
    lines = df._jdf.queryExecution().executedPlan().toString()
    lines = lines.split("== Initial Plan ==")[-1].splitlines()
    depth = [len(re.match(r"[\s:+\-*()0-9]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i + 1 : end])


@pytest.mark.parametrize("name", ["gaps", "episodes", "segment_latest"])
def test_no_reading_is_exchanged(spark, laid_out, name):
    found = {
        "gaps": lambda: layout.gaps(spark, laid_out),
        "episodes": lambda: layout.episodes(spark, laid_out, ["incident_type"]),
        "segment_latest": lambda: layout.segment_latest(spark, laid_out),
    }[name]()
    folded = {"gaps": "max_by", "episodes": "_run", "segment_latest": "_rank"}[name]
    below = list(subtrees_of_exchanges(found))
    assert below and all("FileScan" in text and folded in text for text in below)
    assert all("Bucketed: true" in text for text in below)


def test_a_hot_segment_lies_in_several_buckets(spark, laid_out):
    hot = spark.table(laid_out).filter("road_segment_id = 'HOT'")
    files = hot.select(F.input_file_name().alias("f"), "event_date").distinct().collect()
    assert len({r.f for r in files}) > 1
    assert len(files) == len({r.event_date for r in files})  # a day lies in one


def test_a_load_can_be_added(spark, readings, make, laid_out):
    more = make([row(400, "HOT", "2026-07-05 23:30:00"), row(401, "NEW", "2026-07-06 00:00:00")], SCHEMA)
    layout.write_by_segment(more, "readings", 4, "layout_test", append=True)
    whole = readings.unionByName(more)
    same(layout.gaps(spark, laid_out), sequences.observation_gaps(whole))
    same(layout.segment_latest(spark, laid_out), marts.dim_road_segment(whole))


def test_empty_table(spark, readings):
    full = layout.write_by_segment(readings.limit(0), "none", 4, "layout_empty")
    assert layout.gaps(spark, full).count() == layout.segment_latest(spark, full).count() == 0
    assert layout.episodes(spark, full, ["incident_type"]).count() == 0
    spark.sql("DROP DATABASE layout_empty CASCADE")
