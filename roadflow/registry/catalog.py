"""Registry of queries: each name has a Spark function and, where SQL can say it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadflow.functions import fixed
from roadflow.operators.dedup import keep_first, keep_latest
from roadflow.operators.records import clean, computed_once
from roadflow.operators.windows import window_metrics
from roadflow.plans.staging import EVENT_TEXT, stage_events, stage_metrics
from roadflow.registry.observations import AREAS_SQL, OBSERVATIONS_SQL, SEGMENTS_SQL, observations

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# Recorded decimals of the readings, which make averages exact.
DECIMALS = {"vehicle_count": 0, "avg_speed_kmph": 2, "occupancy_pct": 1}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = f"WITH {PRELUDE}\n{sql.strip()}"
        return run

    return register


# ---- the tables most queries start from -------------------------------------------------------
def staged_events(spark: SparkSession, d: str) -> DataFrame:
    return stage_events(observations(spark, d))


def valid_events(spark: SparkSession, d: str) -> DataFrame:
    return clean(computed_once(staged_events(spark, d)))


def latest(spark: SparkSession, d: str) -> DataFrame:
    return keep_latest(valid_events(spark, d))


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return window_metrics(keep_first(valid_events(spark, d)), decimals=DECIMALS)


def staged_metrics(spark: SparkSession, d: str) -> DataFrame:
    return stage_metrics(metrics(spark, d))


# ---- the same in SQL ---------------------------------------------------------------------------
def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def sql_mean(column: str, decimals: int, places: int = 2) -> str:
    """Average of whole units, halves up; for sums that are not negative."""
    total = f"sum(CAST(round({column} * 1e{decimals}) AS BIGINT)) * {10 ** (places - decimals)}"
    return f"((2 * {total} + count({column})) // nullif(2 * count({column}), 0))::DOUBLE / 1e{places}"


def sql_case(subject: str, pairs: dict, default: str = "NULL") -> str:
    def literal(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in pairs.items())
    return f"CASE {subject} {arms} ELSE {default} END"


def sql_label(column: str) -> str:
    return sql_case(
        f"lower(trim({column}))", {v.lower(): v for v in fixed.RANKED_LEVELS}, f"nullif(trim({column}), '')"
    )


def sql_rank(column: str, labels=fixed.RANKED_LEVELS) -> str:
    return sql_case(f"lower(trim({column}))", {v.lower(): i for i, v in enumerate(labels, 1)})


def sql_unrank(column: str, labels=fixed.RANKED_LEVELS) -> str:
    return sql_case(column, dict(enumerate(labels, 1)))


def sql_metrics(source: str, grain: str = "area, road_segment_id, road_name") -> str:
    rank = f"max({sql_rank('congestion_level')})"
    return f"""
      SELECT time_bucket(INTERVAL 5 MINUTES, event_ts) AS window_start,
        time_bucket(INTERVAL 5 MINUTES, event_ts) + INTERVAL 5 MINUTES AS window_end, {grain},
        count(*) AS event_count, {sql_mean('vehicle_count', 0)} AS avg_vehicle_count,
        {sql_mean('avg_speed_kmph', 2)} AS avg_speed_kmph, {sql_mean('occupancy_pct', 1)} AS avg_occupancy_pct,
        {sql_unrank(rank)} AS peak_congestion_level
      FROM {source} GROUP BY ALL"""


def sql_only(keys: str, order: str, source: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


def sql_key(column: str) -> str:
    return f"md5(lower(trim({column})))"


def sql_day_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INT)"


VALID_SQL = f"""vehicle_count >= 0 AND avg_speed_kmph >= 0 AND occupancy_pct BETWEEN 0 AND 100
        AND congestion_level IN ({sql_list(fixed.RANKED_LEVELS)})
        AND event_id IS NOT NULL AND event_ts IS NOT NULL AND area IS NOT NULL AND road_segment_id IS NOT NULL"""

_TIDY = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in EVENT_TEXT)

PRELUDE = f"""obs AS ({OBSERVATIONS_SQL}),
    seg AS ({SEGMENTS_SQL}),
    areas AS ({AREAS_SQL}),
    stg AS (SELECT * REPLACE ({_TIDY}, {sql_label('congestion_level')} AS congestion_level) FROM obs),
    valid AS (SELECT * FROM stg WHERE {VALID_SQL}),
    latest AS ({sql_only('event_id', 'generated_at DESC NULLS LAST, event_ts DESC NULLS LAST', 'valid')}),
    earliest AS ({sql_only('event_id', 'generated_at, event_ts', 'valid')}),
    met AS ({sql_metrics('earliest')}),
    smet AS (SELECT * EXCLUDE (event_count), event_count AS total_events,
      {sql_rank('peak_congestion_level')} AS peak_congestion_rank FROM met),
    days AS (SELECT CAST(event_ts AS DATE) AS d FROM latest UNION SELECT CAST(window_start AS DATE) FROM smet),
    dim_date AS (SELECT {sql_day_key('d')} AS date_key, d AS date_day, year(d)::INT AS year,
      quarter(d)::INT AS quarter, month(d)::INT AS month, strftime(d, '%b') AS month_name,
      day(d)::INT AS day_of_month, isodow(d)::INT AS day_of_week, strftime(d, '%a') AS day_name,
      isodow(d) >= 6 AS is_weekend FROM days),
    dim_weather AS (SELECT DISTINCT {sql_key('weather')} AS weather_key, weather FROM latest WHERE weather IS NOT NULL),
    dim_incident AS (SELECT DISTINCT {sql_key('incident_type')} AS incident_key, incident_type
      FROM latest WHERE incident_type IS NOT NULL),
    dim_segment AS (SELECT road_segment_id, area, road_name, latitude, longitude FROM (
      {sql_only('road_segment_id', 'generated_at DESC, event_ts DESC, area DESC, road_name DESC NULLS LAST, '
                'latitude DESC NULLS LAST, longitude DESC NULLS LAST', 'latest')})),
    fact_events AS (SELECT event_id, {sql_day_key('event_ts')} AS date_key, road_segment_id,
      {sql_key('weather')} AS weather_key, {sql_key('incident_type')} AS incident_key, event_ts, vehicle_count,
      avg_speed_kmph, occupancy_pct, congestion_level, incident_duration_minutes FROM latest),
    fact_5min AS (SELECT {sql_day_key('window_start')} AS date_key, road_segment_id, window_start, window_end, area,
      road_name, total_events, avg_vehicle_count, avg_speed_kmph, avg_occupancy_pct, peak_congestion_rank,
      peak_congestion_level FROM smet)"""
