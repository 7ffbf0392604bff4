"""Queries behind the dashboard and the comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadflow.operators import quality, reports, sequences
from roadflow.plans import marts
from roadflow.registry.catalog import latest, query, sql_mean, staged_metrics, valid_events
from roadflow.registry.observations import observations, segments
from roadflow.session import staged

TECH = ["Whitefield", "Electronic City", "Outer Ring Road"]


@query("count_per_segment", "SELECT road_segment_id, count(*) AS n FROM obs GROUP BY 1")
def count_per_segment(spark, d):
    return reports.group_counts(observations(spark, d), ["road_segment_id"])


@query("anomaly_counts", "SELECT anomaly_type, count(*) AS n FROM obs GROUP BY 1")
def anomaly_counts(spark, d):
    return reports.group_counts(observations(spark, d), ["anomaly_type"])


@query(
    "anomaly_rates",
    """SELECT anomaly_type, n, round(n::DOUBLE / sum(n) OVER ()::DOUBLE, 6) AS rate
       FROM (SELECT anomaly_type, count(*) AS n FROM obs GROUP BY 1)""",
)
def anomaly_rates(spark, d):
    return quality.anomaly_rates(observations(spark, d))


@query(
    "min_group_size",
    "SELECT min(n) AS smallest, min(n) >= 10 AS enough FROM (SELECT area_id, count(*) AS n FROM seg GROUP BY 1)",
)
def min_group_size(spark, d):
    return quality.smallest_group(segments(spark, d), "area_id", 10)


@query("unique_check", "SELECT event_id, count(*) AS n FROM obs GROUP BY 1 HAVING count(*) > 1")
def unique_check(spark, d):
    return quality.repeated_keys(observations(spark, d), ["event_id"])


@query(
    "hourly_profile",
    f"""SELECT hour_of_day, {sql_mean('vehicle_count', 0)} AS avg_vehicle_count,
         {sql_mean('avg_speed_kmph', 2)} AS avg_speed_kmph, count(*) AS observations FROM latest GROUP BY 1""",
)
def hourly_profile(spark, d):
    return reports.hourly_profile(latest(spark, d), decimals=2)


_PEAK, _NIGHT = "hour_of_day IN (9, 10, 18, 19)", "hour_of_day IN (2, 3, 4)"


@query(
    "peak_night_ratio",
    f"""SELECT area, round(p, 6) AS peak_vehicles, round(n, 6) AS night_vehicles,
         round(p / nullif(n, 0), 6) AS peak_to_night, peak_speed, night_speed
       FROM (SELECT area, avg(vehicle_count) FILTER ({_PEAK}) AS p, avg(vehicle_count) FILTER ({_NIGHT}) AS n,
         {sql_mean(f'CASE WHEN {_PEAK} THEN avg_speed_kmph END', 2)} AS peak_speed,
         {sql_mean(f'CASE WHEN {_NIGHT} THEN avg_speed_kmph END', 2)} AS night_speed FROM latest GROUP BY 1)""",
)
def peak_night_ratio(spark, d):
    return reports.peak_night_ratio(latest(spark, d), ["area"], decimals=2)


@query(
    "severe_share_by_area",
    """SELECT area, count(*) AS observations,
         round(avg(CASE WHEN congestion_level IN ('High', 'Severe') THEN 1 ELSE 0 END), 6) AS severe_share
       FROM latest WHERE hour_of_day IN (9, 18, 19) GROUP BY 1""",
)
def severe_share_by_area(spark, d):
    """Share of the upper levels at peak hours."""
    return reports.severe_share(latest(spark, d), hours=(9, 18, 19))


@query(
    "weekday_weekend",
    """SELECT area, round(a, 6) AS weekday_vehicles, round(b, 6) AS weekend_vehicles,
         round(a / nullif(b, 0), 6) AS weekday_to_weekend
       FROM (SELECT area, avg(vehicle_count) FILTER (NOT is_weekend) AS a, avg(vehicle_count) FILTER (is_weekend) AS b
         FROM latest WHERE area IN ('Whitefield', 'Electronic City', 'Outer Ring Road') AND hour_of_day = 9
         GROUP BY 1)""",
)
def weekday_weekend(spark, d):
    return reports.weekday_weekend(latest(spark, d), TECH, [9])


@query(
    "occ_speed_corr",
    "SELECT area, round(corr(occupancy_pct, avg_speed_kmph), 6) AS correlation FROM latest GROUP BY 1",
)
def occ_speed_corr(spark, d):
    return reports.occupancy_speed_correlation(latest(spark, d), ["area"])


@query(
    "day_over_day",
    """SELECT *, vehicles - previous_vehicles AS change FROM (SELECT *,
         lag(vehicles) OVER (PARTITION BY road_segment_id ORDER BY day) AS previous_vehicles
       FROM (SELECT road_segment_id, CAST(event_ts AS DATE) AS day, sum(vehicle_count)::BIGINT AS vehicles
         FROM latest GROUP BY ALL))""",
)
def day_over_day(spark, d):
    return reports.day_over_day(latest(spark, d))


@query(
    "kpi_totals",
    f"""SELECT (SELECT count(*) FROM fact_5min) AS windows, sum(vehicle_count)::BIGINT AS total_vehicles,
         {sql_mean('avg_speed_kmph', 2)} AS avg_speed_kmph,
         round(sum(CAST(round(occupancy_pct * 100) AS BIGINT))::DOUBLE / count(occupancy_pct) / 100, 2)
           AS avg_occupancy_pct FROM fact_events""",
)
def kpi_totals(spark, d):
    events, windows = marts.fact_events(latest(spark, d)), marts.fact_5min(staged_metrics(spark, d))
    return reports.kpi_totals(events, windows, decimals=2)


@query(
    "congestion_split",
    """SELECT peak_congestion_level, n, round(100 * round(n::DOUBLE / sum(n) OVER ()::DOUBLE, 10), 2) AS percent
       FROM (SELECT peak_congestion_level, count(*) AS n FROM smet GROUP BY 1)""",
)
def congestion_split(spark, d):
    return reports.congestion_split(staged_metrics(spark, d))


@query(
    "congestion_trend",
    f"""SELECT area, hour(window_start)::INT AS hour, {sql_mean('peak_congestion_rank', 0, 4)} AS avg_rank,
         count(*) AS windows FROM smet GROUP BY ALL""",
)
def congestion_trend(spark, d):
    return reports.congestion_trend(staged_metrics(spark, d))


@query("area_rank", f"SELECT area, {sql_mean('peak_congestion_rank', 0, 4)} AS avg_rank FROM smet GROUP BY 1")
def area_rank(spark, d):
    return reports.area_rank(staged_metrics(spark, d))


@query("area_volume", "SELECT area, sum(vehicle_count)::BIGINT AS vehicles FROM latest GROUP BY 1 ORDER BY 2 DESC, 1")
def area_volume(spark, d):
    return reports.area_volume(latest(spark, d))


@query(
    "top_areas",
    "SELECT area, sum(vehicle_count)::BIGINT AS vehicles FROM latest GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def top_areas(spark, d):
    return reports.top_areas(latest(spark, d))


@query(
    "row_reconcile",
    """SELECT step, "table", n, n - (SELECT count(*) FROM obs) AS difference FROM (
         SELECT 0 AS step, 'raw' AS "table", count(*) AS n FROM obs
         UNION ALL SELECT 1, 'valid', count(*) FROM valid
         UNION ALL SELECT 2, 'fact_events', count(*) FROM fact_events
         UNION ALL SELECT 3, 'fact_5min', count(*) FROM fact_5min)""",
)
def row_reconcile(spark, d):
    return quality.reconcile(
        {
            "raw": observations(spark, d),
            "valid": valid_events(spark, d),
            "fact_events": marts.fact_events(latest(spark, d)),
            "fact_5min": marts.fact_5min(staged_metrics(spark, d)),
        }
    )


@query("event_frontier", "SELECT area, max(event_ts) AS frontier FROM obs GROUP BY 1")
def event_frontier(spark, d):
    return reports.event_frontier(observations(spark, d), ["area"])


def _impact_sql(column: str, base: str) -> str:
    speed = "sum(CAST(round(avg_speed_kmph * 100) AS BIGINT))::DOUBLE / count(avg_speed_kmph)"
    return f"""SELECT {column}, count(avg_speed_kmph) AS observations, {sql_mean('avg_speed_kmph', 2)} AS avg_speed_kmph,
      {sql_mean('vehicle_count', 0)} AS avg_vehicle_count,
      round({speed} / (SELECT {speed} FROM latest WHERE {column} = '{base}'), 4) AS speed_vs_base
      FROM latest GROUP BY 1"""


@query("weather_impact", _impact_sql("weather", "Clear"))
def weather_impact(spark, d):
    return reports.weather_impact(latest(spark, d), 2)


@query("incident_impact", _impact_sql("incident_type", "None"))
def incident_impact(spark, d):
    return reports.incident_impact(latest(spark, d), 2)


@query(
    "lag_by_anomaly",
    """SELECT anomaly_type, count(*) AS n, min(ms)::DOUBLE / 1e3 AS min_seconds, max(ms)::DOUBLE / 1e3 AS max_seconds,
         round(sum(ms)::DOUBLE / count(*)::DOUBLE / 1e3, 3) AS avg_seconds
       FROM (SELECT anomaly_type, date_diff('millisecond', event_ts, generated_at) AS ms FROM obs) GROUP BY 1""",
)
def lag_by_anomaly(spark, d):
    return reports.arrival_lag(observations(spark, d))


_SHARES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@query(
    "lag_quantiles",
    f"""SELECT anomaly_type, area, count(*) AS n, {', '.join(f'true AS {q}_within' for q in _SHARES)}
       FROM obs WHERE event_ts IS NOT NULL AND generated_at IS NOT NULL GROUP BY ALL""",
)
def lag_quantiles(spark, d):
    """Lags by kind and area from sketches by kind, area and day; whether each is within 1 % of its rank among all rows."""
    events = observations(spark, d).dropna(subset=["event_ts", "generated_at"])
    keys = ["anomaly_type", "area"]
    by_day = reports.lag_sketches(events.withColumn("day", F.to_date("event_ts")), [*keys, "day"])
    found = staged(reports.lag_quantiles(by_day, keys), "quantiles")
    millis = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("generated_at"))
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    rows = events.select(*keys, millis.alias("lag")).alias("e").join(found.alias("q"), same[0] & same[1])
    counts = [f(F.when(condition, 1)).alias(f"{q}_{name}") for q in _SHARES for name, f, condition in (
        ("below", F.count, F.col("lag") < F.col(q)), ("upto", F.count, F.col("lag") <= F.col(q)))]
    ranks = rows.groupBy(*[F.col(f"q.{k}").alias(k) for k in keys], "q.n").agg(*counts)
    within = [
        ((F.col(f"{q}_below") <= (p + 0.01) * F.col("n")) & (F.col(f"{q}_upto") >= (p - 0.01) * F.col("n"))).alias(f"{q}_within")
        for q, p in _SHARES.items()
    ]
    return ranks.select(*keys, "n", *within)


@query(
    "late_events",
    """SELECT area, count(*) AS n, count(*) FILTER (late) AS late, round(avg(late::INT), 6) AS late_share
       FROM (SELECT area, date_diff('millisecond', event_ts, generated_at) > 600000 AS late FROM obs) GROUP BY 1""",
)
def late_events(spark, d):
    return reports.late_events(observations(spark, d))


@query(
    "level_episodes",
    """SELECT road_segment_id, episode, any_value(congestion_level) AS congestion_level, min(event_ts) AS start_ts,
         max(event_ts) AS end_ts, count(*) AS observations
       FROM (SELECT *, (row_number() OVER (PARTITION BY road_segment_id ORDER BY event_ts)
           - row_number() OVER (PARTITION BY road_segment_id, congestion_level ORDER BY event_ts)) AS island,
           sum(change) OVER (PARTITION BY road_segment_id ORDER BY event_ts)::BIGINT AS episode
         FROM (SELECT *, CASE WHEN congestion_level = lag(congestion_level)
             OVER (PARTITION BY road_segment_id ORDER BY event_ts) THEN 0 ELSE 1 END AS change FROM latest))
       GROUP BY 1, 2""",
)
def level_episodes(spark, d):
    """Runs of the same congestion level on a segment."""
    return sequences.episodes(latest(spark, d), ["congestion_level"])
