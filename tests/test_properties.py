"""Ordered operators against a plain walk over the rows, on random data with a segment that holds most rows."""

from datetime import datetime, timedelta
from itertools import groupby

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadflow.operators import dedup, quality, sequences

START = datetime(2026, 7, 1, 20)
ROW = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "cold"]),
    st.integers(0, 60 * 60),  # minutes, over three days
    st.sampled_from(["None", "Accident", None]),
    st.integers(0, 400),
)
RUNS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    data = [
        (s, START + timedelta(minutes=m), i, START + timedelta(minutes=m + g), f"{s}-{m}") for s, m, i, g in rows
    ]
    schema = (
        "road_segment_id string, event_ts timestamp_ntz, incident_type string, generated_at timestamp_ntz, event_id string"
    )
    return spark.createDataFrame(data, schema), data


def by_segment(data):
    return {k: list(v) for k, v in groupby(sorted(data, key=lambda r: r[0]), key=lambda r: r[0])}


@RUNS
@given(st.lists(ROW, min_size=1, max_size=60))
def test_gaps(spark, rows):
    df, data = frame(spark, rows)
    want = set()
    for key, part in by_segment(data).items():
        times = sorted({r[1] for r in part})
        want |= {(key, t, b, (t - b).total_seconds() if b else None) for b, t in zip([None, *times], times)}
    got = sequences.observation_gaps(df)
    assert {(r.road_segment_id, r.event_ts, r.previous_ts, r.gap_seconds) for r in got.collect()} == want


@RUNS
@given(st.lists(ROW, min_size=1, max_size=60))
def test_inversions(spark, rows):
    df, data = frame(spark, rows)
    want = {}
    for key, part in by_segment(data).items():
        order = sorted(part, key=lambda r: (r[3], r[1]))
        want[key] = (len(part), sum(b[1] < a[1] for a, b in zip(order, order[1:])))
    got = sequences.order_inversions(df).collect()
    assert {r.road_segment_id: (r.observations, r.inversions) for r in got} == want


@RUNS
@given(st.lists(ROW, min_size=1, max_size=60))
def test_episodes(spark, rows):
    df, data = frame(spark, rows)
    want = set()
    for key, part in by_segment(data).items():
        order = sorted(part, key=lambda r: (r[1], r[2] is not None, r[2] or ""))
        for n, (label, run) in enumerate(groupby(order, key=lambda r: r[2]), 1):
            run = list(run)
            want.add((key, n, label, run[0][1], run[-1][1], len(run)))
    got = sequences.episodes(df, ["incident_type"]).collect()
    assert {tuple(r) for r in got} == want


@RUNS
@given(st.lists(ROW, min_size=1, max_size=40))
def test_latest_and_duplicates(spark, rows):
    df, data = frame(spark, rows)
    want = {}
    for r in data:
        want[r[4]] = max(want.get(r[4], r[3]), r[3])
    got = dedup.keep_latest(df).collect()
    assert {r.event_id: r.generated_at for r in got} == want
    repeated = {r.event_id: r.n for r in quality.repeated_keys(df, ["event_id"]).collect()}
    ids = [r[4] for r in data]
    assert repeated == {i: ids.count(i) for i in ids if ids.count(i) > 1}
