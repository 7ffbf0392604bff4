import datetime as dt

from roadflow.registry import QUERIES

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_metric_model_gives_every_event_beside_its_readings(spark, tmp_path):
    start = dt.datetime(2024, 3, 1, 7, 30)
    rows = [(n, start + dt.timedelta(minutes=n), n % 4 + 1, "view", 20.0 + n, '{"k": %d}' % (n % 50)) for n in range(1, 41)]
    spark.createDataFrame(rows, EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    customers = [(n, n) for n in range(1, 5)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    found = QUERIES["metric_model"](spark, str(tmp_path)).collect()
    assert len(found) == len({r.event_id for r in found}) == 40
    by_speed = {r.observed_speed: r for r in found}
    assert sorted(by_speed) == [20.0 + n for n in range(1, 41)]
    open_roads = [r for r in found if r.vehicles is not None and r.speed]
    assert open_roads and all(r.passed <= -(-r.vehicles // 1) and 0 <= r.occupancy <= 98 and r.level for r in open_roads)
    closed = by_speed[26.0]  # n = 6: Road_Closure
    assert (closed.passed, closed.speed, closed.occupancy, closed.level) == (0, 0, 0, "Severe")
