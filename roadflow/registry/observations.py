"""Traffic observations derived from the given tables, in Spark and as the SQL the checks run.

``events`` rows become traffic observations: the user is the road segment, the event type the congestion
level, the value the speed and the JSON property the count. Remainders of the event id only choose among
values, so every row is kept; a purchase is delivered twice, the second time as a copy. ``customer`` rows
become the segment dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.functions.labels import lookup
from roadflow.functions.times import (
    day_name,
    event_key,
    floor_second,
    iso_millis,
    iso_seconds,
    iso_weekday,
    plus_millis,
)
from roadflow.sources.files import message

CODES = list(fixed.AREAS)
NAMES = list(fixed.AREAS.values())
LEVEL_OF_TYPE = {"error": "SEVERE ", "view": " low", "click": "Moderate", "signup": "High", "purchase": "Medium"}
WEATHER_CHOICE = ["Clear", " Rain ", "", None, "Cloudy", "rain"]
INCIDENT_CHOICE = ["Accident", " Roadwork ", "None", "", None, "accident", "Road_Closure", "nan", "None"]


def _choose(index: Column, values: list) -> Column:
    return lookup(index, {i: F.lit(v) for i, v in enumerate(values)})


def _nth(index: Column, values: list[str]) -> Column:
    """Value at a 0-based index of a constant array."""
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _segment(number: Column) -> dict[str, Column]:
    """Segment identity and place of a segment number."""
    digits = F.floor(number / 10).cast("string")
    area_no = number % 10
    return {
        "area_id": _nth(area_no, CODES),
        "area": _nth(area_no, NAMES),
        "road_segment_id": F.concat(
            _nth(area_no, CODES), F.lit("-"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0"))
        ),
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations_of(events: DataFrame) -> DataFrame:
    """Observations with typed times; works on a batch and on a stream.

    Values are computed first and copies are made last, so a value is computed once for all its copies.
    """
    n, user = F.col("event_id"), F.col("user_id")
    place = _segment(user)
    read = events.select(
        n,
        user,
        "ts",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        floor_second("ts").alias("slot"),
        place["road_segment_id"].alias("segment"),
        _choose(n % 9, INCIDENT_CHOICE).alias("incident"),
        F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
        .alias("copies"),
    )
    k, slot, copy = F.col("k"), F.col("slot"), F.col("copy")
    delay = F.when(n % 23 == 0, k + 5).otherwise(F.lit(0))
    sent = plus_millis(slot, (delay * 60 + 60) * 1000 + 200 + n * 37 % 4800 + copy * (n % 29 + 1) * 1000)
    label = F.when(n % 23 == 0, "Delayed").when(n % 19 == 0, "nan").otherwise("None")
    return read.withColumn("copy", F.explode("copies")).select(
        event_key("segment", "slot").alias("event_id"),
        slot.alias("event_ts"),
        place["area"].alias("area"),
        F.col("segment").alias("road_segment_id"),
        F.when(n % 17 != 0, F.concat(F.lit("Road "), user.cast("string"))).alias("road_name"),
        F.when(n % 109 == 0, None)
        .when(n % 107 == 0, F.lit(0.0))
        .otherwise((user * 4999 % 500_000 + 12_700_000) / F.lit(1e6))
        .alias("latitude"),
        F.when(n % 113 != 0, (user * 7919 % 500_000 + 77_400_000) / F.lit(1e6)).alias("longitude"),
        (k - F.when(n % 101 == 0, 100).otherwise(0)).alias("vehicle_count"),
        F.col("value").alias("avg_speed_kmph"),
        F.when(n % 97 == 0, None)
        .when(n % 103 == 0, (k + 1005) / F.lit(10.0))
        .otherwise((k * 10 + n % 10) / F.lit(10.0))
        .alias("occupancy_pct"),
        lookup("event_type", LEVEL_OF_TYPE).alias("congestion_level"),
        _choose(n % 6, WEATHER_CHOICE).alias("weather"),
        F.col("incident").alias("incident_type"),
        F.when(n % 31 == 0, None)
        .when(n % 127 == 0, F.lit(-5))
        .when(F.col("incident") == "None", F.lit(0))
        .otherwise(k + 10)
        .alias("incident_duration_minutes"),
        ((iso_weekday("ts") >= 6) != (n % 83 == 0)).alias("is_weekend"),
        (F.hour("ts") + F.when(n % 89 == 0, 1).otherwise(0)).alias("hour_of_day"),
        day_name("ts").alias("day_of_week"),
        F.when(n % 131 == 0, "roadside").otherwise(fixed.DATA_SOURCE).alias("data_source"),
        sent.alias("generated_at"),
        F.when(copy == 1, "Duplicate").otherwise(label).alias("anomaly_type"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_of(table(spark, sf_dir, "events"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment dimension of the ``customer`` table."""
    c, nation = F.col("c_custkey"), F.col("c_nationkey")
    place = _segment(c)
    return table(spark, sf_dir, "customer").select(
        place["road_segment_id"].alias("road_segment_id"),
        place["area_id"].alias("area_id"),
        place["area"].alias("area"),
        F.concat(F.lit("Road "), c.cast("string")).alias("road_name"),
        ((c * 4999 % 500_000 + 12_700_000) / F.lit(1e6)).alias("latitude"),
        ((c * 7919 % 500_000 + 77_400_000) / F.lit(1e6)).alias("longitude"),
        _choose(nation % 5, [*fixed.ROAD_TYPES, "Track"]).alias("road_type"),
        (nation % 6 + 1).cast("int").alias("lane_count"),
        (c % 8 * 10 + 15).cast("int").alias("speed_limit_kmph"),
        (c % 100 + 16).cast("double").alias("capacity_vehicles_per_minute"),
        ((c % 25 + 78) / F.lit(100.0)).alias("free_flow_ratio"),
        ((c % 31 + 85) / F.lit(100.0)).alias("base_demand_factor"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area dimension: one row per area that has segments."""
    seg = segments(spark, sf_dir)
    return seg.groupBy("area_id", "area").agg(F.round(F.avg("latitude"), 4).alias("center_latitude")).select(
        "area_id",
        "area",
        lookup("area", fixed.AREA_TYPES).alias("area_type"),
        lookup("area", {a: F.lit(1.0 + i / 20) for i, a in enumerate(NAMES)}).alias("peak_demand_ratio"),
        "center_latitude",
    )


def wire(df: DataFrame) -> DataFrame:
    """Observations as they travel: times as ISO text, columns in contract order."""
    return df.withColumns(
        {"event_timestamp": iso_seconds("event_ts"), "generated_at": iso_millis("generated_at")}
    ).select(*fixed.EVENT_COLUMNS)


def messages(df: DataFrame) -> DataFrame:
    """Wire records as one JSON text per row, with the record's id."""
    rows = wire(df)
    return rows.select("event_id", "anomaly_type", message(rows.columns).alias("value"))


# The same mapping for the checks.
def _case(subject: str, values: list) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + str(v) + chr(39)}" for i, v in enumerate(values)
    )
    return f"CASE {subject} {arms} END"


def _by_name(subject: str, pairs: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, (int, float)) else chr(39) + v + chr(39)}" for k, v in pairs.items())
    return f"CASE {subject} {arms} END"


def _segment_sql(n: str) -> str:
    digits = f"CAST({n} // 10 AS VARCHAR)"
    return f"{_case(f'{n} % 10', CODES)} || '-' || lpad({digits}, greatest(3, length({digits}))::INT, '0')"


OBSERVATIONS_SQL = f"""
SELECT
  {_segment_sql('user_id')} || '_' || strftime(slot, '%Y%m%dT%H%M%S') AS event_id,
  slot AS event_ts,
  {_case('user_id % 10', NAMES)} AS area,
  {_segment_sql('user_id')} AS road_segment_id,
  CASE WHEN n % 17 <> 0 THEN 'Road ' || user_id END AS road_name,
  CASE WHEN n % 109 = 0 THEN NULL WHEN n % 107 = 0 THEN 0.0::DOUBLE
       ELSE (user_id * 4999 % 500000 + 12700000)::DOUBLE / 1e6 END AS latitude,
  CASE WHEN n % 113 <> 0 THEN (user_id * 7919 % 500000 + 77400000)::DOUBLE / 1e6 END AS longitude,
  (k - CASE WHEN n % 101 = 0 THEN 100 ELSE 0 END)::INT AS vehicle_count,
  value AS avg_speed_kmph,
  CASE WHEN n % 97 = 0 THEN NULL WHEN n % 103 = 0 THEN (k + 1005)::DOUBLE / 1e1
       ELSE (k * 10 + n % 10)::DOUBLE / 1e1 END AS occupancy_pct,
  {_by_name('event_type', LEVEL_OF_TYPE)} AS congestion_level,
  {_case('n % 6', WEATHER_CHOICE)} AS weather,
  incident AS incident_type,
  CASE WHEN n % 31 = 0 THEN NULL WHEN n % 127 = 0 THEN -5 WHEN incident = 'None' THEN 0 ELSE k + 10 END::INT
    AS incident_duration_minutes,
  (isodow(ts) >= 6) <> (n % 83 = 0) AS is_weekend,
  (hour(ts) + CASE WHEN n % 89 = 0 THEN 1 ELSE 0 END)::INT AS hour_of_day,
  strftime(ts, '%A') AS day_of_week,
  CASE WHEN n % 131 = 0 THEN 'roadside' ELSE '{fixed.DATA_SOURCE}' END AS data_source,
  slot + to_milliseconds(60200 + n * 37 % 4800) + to_minutes(CASE WHEN n % 23 = 0 THEN k + 5 ELSE 0 END)
    + to_seconds(copy * (n % 29 + 1)) AS generated_at,
  CASE WHEN copy = 1 THEN 'Duplicate' WHEN n % 23 = 0 THEN 'Delayed' WHEN n % 19 = 0 THEN 'nan' ELSE 'None' END
    AS anomaly_type
FROM (
  SELECT *, event_id AS n, date_trunc('second', ts) AS slot, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    {_case('event_id % 9', INCIDENT_CHOICE)} AS incident,
    unnest(CASE WHEN event_type = 'purchase' THEN [0, 1] ELSE [0] END) AS copy
  FROM events)
"""

SEGMENTS_SQL = f"""
SELECT {_segment_sql('c_custkey')} AS road_segment_id, {_case('c_custkey % 10', CODES)} AS area_id,
  {_case('c_custkey % 10', NAMES)} AS area, 'Road ' || c_custkey AS road_name,
  (c_custkey * 4999 % 500000 + 12700000)::DOUBLE / 1e6 AS latitude,
  (c_custkey * 7919 % 500000 + 77400000)::DOUBLE / 1e6 AS longitude,
  {_case('c_nationkey % 5', [*fixed.ROAD_TYPES, 'Track'])} AS road_type,
  (c_nationkey % 6 + 1)::INT AS lane_count, (c_custkey % 8 * 10 + 15)::INT AS speed_limit_kmph,
  (c_custkey % 100 + 16)::DOUBLE AS capacity_vehicles_per_minute,
  (c_custkey % 25 + 78)::DOUBLE / 1e2 AS free_flow_ratio, (c_custkey % 31 + 85)::DOUBLE / 1e2 AS base_demand_factor
FROM customer
"""

AREAS_SQL = f"""
SELECT area_id, area, {_by_name('area', fixed.AREA_TYPES)} AS area_type,
  {_by_name('area', {a: 1.0 + i / 20 for i, a in enumerate(NAMES)})}::DOUBLE AS peak_demand_ratio
FROM (SELECT DISTINCT area_id, area FROM seg)
"""
