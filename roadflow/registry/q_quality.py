"""Queries on data quality: ranges, contract, cross-field rules, anomalies, faults, dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.operators import joins, quality
from roadflow.operators.records import failing
from roadflow.registry.catalog import latest, query, sql_list, staged_events
from roadflow.registry.observations import messages, observations, segments, wire
from roadflow.registry.q_joins import SEGMENT_FACTS, city
from roadflow.sources import files
from roadflow.sources.contract import event_contract


def sql_codes(pairs: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in pairs) + ")"


RANGE_SQL = sql_codes(
    [
        ("latitude", "latitude NOT BETWEEN -90 AND 90"),
        ("longitude", "longitude NOT BETWEEN -180 AND 180"),
        ("occupancy_pct", "occupancy_pct NOT BETWEEN 0 AND 100"),
        ("hour_of_day", "hour_of_day NOT BETWEEN 0 AND 23"),
        ("vehicle_count", "vehicle_count < 0"),
        ("avg_speed_kmph", "avg_speed_kmph < 0"),
        ("incident_duration_minutes", "incident_duration_minutes < 0"),
    ]
)


@query(
    "range_violations",
    f"SELECT event_id, anomaly_type, {RANGE_SQL} AS failed FROM stg WHERE {RANGE_SQL} <> ''",
)
def range_violations(spark, d):
    return quality.range_violations(staged_events(spark, d), ["event_id", "anomaly_type"])


VALUE_TESTS = [
    ("pattern:event_id", f"NOT regexp_matches(event_id, '{fixed.EVENT_ID_PATTERN}')"),
    ("enum:area", f"area NOT IN ({sql_list(fixed.AREAS.values())})"),
    ("pattern:road_segment_id", f"NOT regexp_matches(road_segment_id, '{fixed.SEGMENT_ID_PATTERN}')"),
    ("minimum:latitude", "latitude < 12.7"),
    ("maximum:latitude", "latitude > 13.2"),
    ("minimum:longitude", "longitude < 77.4"),
    ("maximum:longitude", "longitude > 77.9"),
    ("minimum:vehicle_count", "vehicle_count < 0"),
    ("minimum:avg_speed_kmph", "avg_speed_kmph < 0"),
    ("minimum:occupancy_pct", "occupancy_pct < 0"),
    ("maximum:occupancy_pct", "occupancy_pct > 100"),
    ("enum:congestion_level", f"congestion_level NOT IN ({sql_list(fixed.SCORED_LEVELS)})"),
    ("enum:weather", f"weather NOT IN ({sql_list(fixed.WEATHER)})"),
    ("null:incident_type", "incident_type IS NULL"),
    ("enum:incident_type", f"incident_type NOT IN ({sql_list(fixed.INCIDENTS)})"),
    ("minimum:incident_duration_minutes", "incident_duration_minutes < 0"),
    ("minimum:hour_of_day", "hour_of_day < 0"),
    ("maximum:hour_of_day", "hour_of_day > 23"),
    ("enum:day_of_week", f"day_of_week NOT IN ({sql_list(fixed.DAY_NAMES)})"),
    ("const:data_source", f"data_source <> '{fixed.DATA_SOURCE}'"),
    ("enum:anomaly_type", f"anomaly_type NOT IN ({sql_list(fixed.ANOMALIES)})"),
]


@query(
    "contract_violations",
    f"SELECT * FROM (SELECT event_id, anomaly_type, {sql_codes(VALUE_TESTS)} AS violations FROM obs) WHERE violations <> ''",
)
def contract_violations(spark, d):
    rows = event_contract().violations(wire(observations(spark, d)))
    return rows.select("event_id", "anomaly_type", "violations")


_LATE = "anomaly_type = 'None' AND hour_of_day"
_JSON_TESTS = [
    ("offset:generated_at", f"{_LATE} = 7"),
    ("undeclared", "anomaly_type = 'Delayed'"),
    ("order:generated_at", f"{_LATE} = 9"),
    ("key:event_id", f"{_LATE} = 8"),
]
_AREA = [("missing:area", "anomaly_type = 'Delayed'")]
_COUNT = [("type:vehicle_count", "anomaly_type = 'nan'")]


def _json_tests() -> list[tuple[str, str]]:
    tests = []
    for code, test in VALUE_TESTS:
        if code == "enum:area":
            tests += _AREA + [(code, f"anomaly_type <> 'Delayed' AND {test}")]
        elif code == "minimum:vehicle_count":
            tests += _COUNT + [(code, f"anomaly_type <> 'nan' AND {test}")]
        else:
            tests.append((code, test))
    at = [code for code, _ in tests].index("enum:anomaly_type")
    return tests[:at] + _JSON_TESTS[:1] + tests[at:] + _JSON_TESTS[1:]


@query(
    "json_contract",
    f"""SELECT event_id, anomaly_type, CASE WHEN anomaly_type = 'Duplicate' THEN 'not_an_object'
         ELSE {sql_codes(_json_tests())} END AS violations FROM obs""",
)
def json_contract(spark, d):
    """Raw messages, some broken: a renamed field, a number sent as text, a cut-off record, another offset, the id of
    another century, a record made before its event."""
    value, kind = F.col("value"), F.col("anomaly_type")
    renamed = F.replace(value, F.lit('"area":'), F.lit('"zone":'))
    quoted = F.regexp_replace(value, r'"vehicle_count":(-?\d+)', '"vehicle_count":"$1"')
    cut = F.left(value, (F.length(value) / 2).cast("int"))
    moved = F.regexp_replace(value, r'("generated_at":"[^"]*)\+05:30"', '$1+05:00"')
    other = F.regexp_replace(value, r'("event_id":"[^_]*_)20', "$119")
    early = F.regexp_replace(value, r'"generated_at":"20', '"generated_at":"19')
    late, hour = kind == "None", F.get_json_object(value, "$.hour_of_day")
    sent = messages(observations(spark, d)).withColumn(
        "value",
        F.when(kind == "Delayed", renamed)
        .when(kind == "nan", quoted)
        .when(kind == "Duplicate", cut)
        .when(late & (hour == "7"), moved)
        .when(late & (hour == "8"), other)
        .when(late & (hour == "9"), early)
        .otherwise(value),
    )
    return event_contract().json_violations(sent).drop("value")


_NONE = "incident_type IS NOT DISTINCT FROM 'None'"
_CLOSED = "incident_type IS NOT DISTINCT FROM 'Road_Closure'"
CROSS_SQL = sql_codes(
    [
        ("speed_over_limit", "avg_speed_kmph > speed_limit_kmph"),
        ("stopped_on_open_road", f"avg_speed_kmph = 0 AND NOT {_CLOSED}"),
        ("duration_without_incident", f"{_NONE} AND incident_duration_minutes <> 0"),
        ("incident_without_duration", "incident_type <> 'None' AND incident_duration_minutes <= 0"),
        ("weekend_flag", "is_weekend <> (day_of_week IN ('Saturday', 'Sunday'))"),
        ("weekend_day", "is_weekend <> (isodow(event_ts) >= 6)"),
        ("day_name", "day_of_week <> strftime(event_ts, '%A')"),
        ("hour", "hour_of_day <> hour(event_ts)"),
        ("count_over_capacity", "vehicle_count > ceil(capacity_vehicles_per_minute)"),
    ]
)


@query(
    "cross_field_rules",
    f"""SELECT event_id, anomaly_type, {CROSS_SQL} AS failed FROM stg LEFT JOIN
         (SELECT road_segment_id, {', '.join(SEGMENT_FACTS)} FROM seg) USING (road_segment_id)
       WHERE {CROSS_SQL} <> ''""",
)
def cross_field_rules(spark, d):
    rows = joins.enrich(staged_events(spark, d), segments(spark, d), SEGMENT_FACTS)
    return failing(rows, quality.cross_field_rules(60), "failed").select("event_id", "anomaly_type", "failed")


_GONE = " OR ".join(f"{c} IS NULL" for c in fixed.OPTIONAL_COLUMNS)
ANOMALY_SQL = sql_codes(
    [
        ("Duplicate", "rn > 1"),
        ("Delayed", "generated_at - event_ts >= INTERVAL 5 MINUTES"),
        ("Missing_Field", _GONE),
        (
            "Invalid_Value",
            "coalesce(vehicle_count < 0, false) OR coalesce(avg_speed_kmph > 100, false) "
            "OR coalesce(occupancy_pct > 100, false) OR coalesce(latitude = 0, false)",
        ),
    ]
)


@query(
    "detect_anomalies",
    f"""SELECT event_id, anomaly_type, generated_at, {ANOMALY_SQL} AS detected FROM (SELECT *, row_number() OVER
         (PARTITION BY event_id ORDER BY generated_at) AS rn FROM obs)""",
)
def detect_anomalies(spark, d):
    found = quality.detect_anomalies(observations(spark, d))
    return found.select("event_id", "anomaly_type", "generated_at", "detected")


_MISSING = sql_codes([(c, f"{c} IS NULL") for c in fixed.OPTIONAL_COLUMNS])


@query(
    "missing_optional",
    f"SELECT event_id, anomaly_type, {_MISSING} AS missing_fields FROM obs WHERE {_GONE}",
)
def missing_optional(spark, d):
    return quality.missing_optional(observations(spark, d), keep=["event_id", "anomaly_type"])


def _band_sql(seed: int) -> str:
    return f"(('0x' || left(md5('{seed}:' || event_id), 8))::BIGINT % 10000)"


@query(
    "inject_faults",
    f"""SELECT event_id, vehicle_count, avg_speed_kmph, occupancy_pct, latitude, road_name, generated_at, anomaly_type
       FROM (SELECT event_id, copy,
         CASE WHEN fault = 'Invalid_Value' AND p % 4 = 0 THEN -(p % 49 + 1) ELSE vehicle_count END::INT AS vehicle_count,
         CASE WHEN fault = 'Invalid_Value' AND p % 4 = 1 THEN 150 + p % 150 ELSE avg_speed_kmph END AS avg_speed_kmph,
         CASE WHEN fault = 'Missing_Field' AND p % 6 = 3 THEN NULL
           WHEN fault = 'Invalid_Value' AND p % 4 = 2 THEN 100.5 + p % 49 ELSE occupancy_pct END AS occupancy_pct,
         CASE WHEN fault = 'Missing_Field' AND p % 6 = 1 THEN NULL
           WHEN fault = 'Invalid_Value' AND p % 4 = 3 THEN 0 ELSE latitude END AS latitude,
         CASE WHEN fault = 'Missing_Field' AND p % 6 = 0 THEN NULL ELSE road_name END AS road_name,
         generated_at + to_minutes(CASE WHEN fault = 'Delayed' THEN p % 116 + 5 ELSE 0 END)
           + to_seconds(copy * (p % 30 + 1)) AS generated_at,
         CASE WHEN fault = 'Duplicate' AND copy = 0 THEN 'None' ELSE fault END AS anomaly_type
       FROM (SELECT *, unnest(CASE WHEN fault = 'Duplicate' THEN [0, 1] ELSE [0] END) AS copy
         FROM (SELECT *, CASE WHEN b < 300 THEN 'Delayed' WHEN b < 700 THEN 'Missing_Field'
             WHEN b < 1200 THEN 'Invalid_Value' WHEN b < 1400 THEN 'Duplicate' ELSE 'None' END AS fault
           FROM (SELECT *, {_band_sql(7)} AS b, {_band_sql(8)} AS p FROM latest))))""",
)
def inject_faults(spark, d):
    faulty = quality.inject_faults(latest(spark, d), 7, delayed_pct=3, missing_pct=4, invalid_pct=5, duplicate_pct=2)
    return faulty.select(
        "event_id",
        "vehicle_count",
        "avg_speed_kmph",
        "occupancy_pct",
        "latitude",
        "road_name",
        "generated_at",
        "anomaly_type",
    )


_SEGMENT_TESTS = [
    ("road_type", f"road_type NOT IN ({sql_list(fixed.ROAD_TYPES)})"),
    ("latitude", "latitude NOT BETWEEN 12.7 AND 13.2"),
    ("longitude", "longitude NOT BETWEEN 77.4 AND 77.9"),
    ("lane_count", "lane_count < 2"),
    ("speed_limit_kmph", "speed_limit_kmph NOT BETWEEN 20 AND 100"),
    ("capacity_vehicles_per_minute", "capacity_vehicles_per_minute <= 0"),
    ("free_flow_ratio", "free_flow_ratio <= 0 OR free_flow_ratio > 1"),
]


@query(
    "dim_rules",
    " UNION ALL ".join(
        f"SELECT road_segment_id AS subject, '{code}' AS problem FROM seg WHERE {test}" for code, test in _SEGMENT_TESTS
    )
    + """ UNION ALL SELECT road_segment_id, 'repeated_id' FROM seg GROUP BY 1 HAVING count(*) > 1
        UNION ALL SELECT area_id, 'area_size' FROM seg GROUP BY 1 HAVING count(*) NOT BETWEEN 10 AND 20""",
)
def dim_rules(spark, d):
    profiles = files.city_profiles(city(spark, d))
    return quality.dimension_problems(segments(spark, d), profiles, (10, 20))
