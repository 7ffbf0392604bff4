"""Queries on records: JSON, parsing, cleaning, labels, keys, times, files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.functions.labels import canonical_label, label_rank, marker_to_null, rank_label, surrogate_key
from roadflow.functions.times import (
    calendar_columns,
    date_key,
    event_key,
    iso_millis,
    iso_seconds,
    local_event_time,
    seconds_between,
)
from roadflow.operators import records, sets
from roadflow.plans import staging
from roadflow.registry.catalog import (
    VALID_SQL,
    latest,
    metrics,
    query,
    sql_day_key,
    sql_key,
    sql_label,
    sql_list,
    sql_rank,
    staged_events,
)
from roadflow.registry.observations import messages, observations, segments, table, wire
from roadflow.session import scratch_path
from roadflow.sources import files
from roadflow.sources.contract import EVENT_SCHEMA, event_contract
from roadflow.sources.tables import by_name, lost_values

ISO = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'"
ISO_MS = "strftime(generated_at, '%Y-%m-%dT%H:%M:%S.%g') || '+05:30'"
WIRE_SQL = ", ".join(
    {"event_timestamp": f"{ISO} AS event_timestamp", "generated_at": f"{ISO_MS} AS generated_at"}.get(c, c)
    for c in fixed.EVENT_COLUMNS
)
OBS_TIMED = ", ".join(["event_ts", *[c for c in fixed.EVENT_COLUMNS if c != "event_timestamp"]])


@query("json_flatten", f"SELECT {WIRE_SQL} FROM obs")
def json_flatten(spark, d):
    return records.flatten_json(messages(observations(spark, d)), EVENT_SCHEMA)


@query(
    "json_dead_letter",
    """SELECT event_id, anomaly_type, CASE anomaly_type WHEN 'Delayed' THEN 'not_json' ELSE 'not_utf8' END AS reason
       FROM obs WHERE anomaly_type IN ('Delayed', 'nan')""",
)
def json_dead_letter(spark, d):
    sent = messages(observations(spark, d))
    cut = F.left("value", (F.length("value") / 2).cast("int")).cast("binary")
    broken = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF")))
    kind = F.col("anomaly_type")
    damaged = sent.withColumn(
        "value", F.when(kind == "Delayed", cut).when(kind == "nan", broken).otherwise(F.col("value").cast("binary"))
    )
    _, bad = records.split_dead_letters(damaged)
    return bad.select("event_id", "anomaly_type", "reason")


@query(
    "to_keyed_json",
    """SELECT road_segment_id AS key, event_id, anomaly_type, road_name, vehicle_count, avg_speed_kmph,
         20 AS n_fields FROM obs""",
)
def to_keyed_json(spark, d):
    keyed = files.keyed_json(wire(observations(spark, d)))

    def text(c):
        return F.get_json_object("value", f"$.{c}")

    return keyed.select(
        "key",
        text("event_id").alias("event_id"),
        text("anomaly_type").alias("anomaly_type"),
        text("road_name").alias("road_name"),
        text("vehicle_count").cast("int").alias("vehicle_count"),
        text("avg_speed_kmph").cast("double").alias("avg_speed_kmph"),
        F.size(F.json_object_keys("value")).alias("n_fields"),
    )


@query(
    "copy_by_name",
    "SELECT event_id, anomaly_type, area, TRY_CAST(weather AS INT) AS vehicle_count, avg_speed_kmph, "
    "CAST(NULL AS DOUBLE) AS occupancy_pct FROM obs",
)
def copy_by_name(spark, d):
    source = observations(spark, d).select(
        F.col("avg_speed_kmph").alias("AVG_SPEED_KMPH"),
        F.col("anomaly_type").alias("Anomaly_Type"),
        F.col("weather").alias("Count"),
        F.col("event_id").alias("EVENT_ID"),
        F.col("area").alias("AREA"),
        F.lit("x").alias("not_wanted"),
    )
    wanted = ["event_id", "anomaly_type", "area", "vehicle_count", "avg_speed_kmph", "occupancy_pct"]
    return by_name(source, T.StructType([EVENT_SCHEMA[c] for c in wanted]), {"count": "vehicle_count"})


@query(
    "load_errors",
    """SELECT field, n FROM (
         SELECT 'props' AS field, count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS BIGINT) IS NULL) AS n FROM events
         UNION ALL SELECT 'kind', count(*) FILTER (event_type IS NOT NULL AND TRY_CAST(event_type AS INT) IS NULL) FROM events
         UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NOT NULL AND TRY_CAST(user_id AS TINYINT) IS NULL) FROM events)
       WHERE n > 0""",
)
def load_errors(spark, d):
    """Values of the raw table that a load into other types would lose, by field."""
    wanted = T.StructType.fromDDL("event_id bigint, kind int, props bigint, user_id tinyint, value string")
    return lost_values(table(spark, d, "events"), wanted, {"event_type": "kind"})


@query(
    "partition_roundtrip",
    """SELECT event_id, anomaly_type, vehicle_count, strftime(event_ts, '%Y') AS year,
         strftime(event_ts, '%m') AS month, strftime(event_ts, '%d') AS day, area FROM obs""",
)
def partition_roundtrip(spark, d):
    obs = observations(spark, d)
    parts = {c: v for c, v in calendar_columns("event_ts").items() if c in fixed.PARTITION_COLUMNS}
    path = scratch_path(spark, "partitioned")
    files.write_partitioned_events(_lake_rows(obs, parts), path)
    back = files.read_partitioned_events(spark, path)
    return back.select("event_id", "anomaly_type", "vehicle_count", "year", "month", "day", "area")


def _lake_rows(obs, parts):
    timed = obs.withColumns(parts | {"event_timestamp": iso_seconds("event_ts"), "generated_at": iso_millis("generated_at")})
    return timed.select(*fixed.EVENT_COLUMNS, "year", "month", "day")


@query(
    "parse_event_ts",
    "SELECT event_id, anomaly_type, CASE WHEN anomaly_type <> 'nan' THEN event_ts END AS local_ts FROM obs",
)
def parse_event_ts(spark, d):
    """Times written in several forms: with offset, without one, in UTC, and unreadable."""
    kind = F.col("anomaly_type")
    text = iso_seconds("event_ts")
    utc = iso_seconds(F.col("event_ts") - F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "+00:00")
    written = F.when(kind == "nan", "bad").when(kind == "Delayed", F.left(text, F.lit(19)))
    written = written.when(kind == "Duplicate", utc).otherwise(text)
    return observations(spark, d).select("event_id", "anomaly_type", local_event_time(written).alias("local_ts"))


@query(
    "sentinel_to_null",
    """SELECT event_id, anomaly_type AS sent_as,
         CASE WHEN incident_type IN ('Nan', 'nan', '') THEN NULL ELSE incident_type END AS incident_type,
         nullif(anomaly_type, 'nan') AS anomaly_type,
         CASE WHEN lower(trim(incident_type)) IN ('nan', '') THEN NULL ELSE incident_type END AS lenient_incident
       FROM obs""",
)
def sentinel_to_null(spark, d):
    obs = observations(spark, d).withColumn("sent_as", F.col("anomaly_type"))
    lenient = marker_to_null(F.concat(F.lit('"'), F.col("incident_type"), F.lit('"')), lenient=True)
    obs = obs.withColumn("lenient_incident", F.translate(lenient, '"', ""))
    return records.with_missing_markers_removed(obs).select(
        "event_id", "sent_as", "incident_type", "anomaly_type", "lenient_incident"
    )


@query("clean_filter", f"SELECT {OBS_TIMED} FROM obs WHERE {VALID_SQL}")
def clean_filter(spark, d):
    return records.clean(observations(spark, d))


@query(
    "clean_rejects",
    f"""SELECT event_id, anomaly_type, reasons FROM (SELECT *, concat_ws(',',
         CASE WHEN event_id IS NULL THEN 'event_id_missing' END,
         CASE WHEN NOT coalesce(vehicle_count >= 0, false) THEN 'vehicle_count_negative' END,
         CASE WHEN NOT coalesce(avg_speed_kmph >= 0, false) THEN 'avg_speed_kmph_negative' END,
         CASE WHEN NOT coalesce(occupancy_pct BETWEEN 0 AND 100, false) THEN 'occupancy_out_of_range' END,
         CASE WHEN NOT coalesce(congestion_level IN ({sql_list(fixed.RANKED_LEVELS)}), false)
           THEN 'unknown_level' END) AS reasons
       FROM (SELECT * REPLACE (CASE congestion_level WHEN 'Moderate' THEN 'Medium' ELSE congestion_level END
         AS congestion_level) FROM obs)) WHERE reasons <> ''""",
)
def clean_rejects(spark, d):
    bad = records.rejected(observations(spark, d), aliases={"Moderate": "Medium"})
    return bad.select("event_id", "anomaly_type", "reasons")


@query("raw_projection", f"SELECT {OBS_TIMED}, {ISO} AS event_timestamp FROM obs WHERE {VALID_SQL}")
def raw_projection(spark, d):
    obs = records.clean(observations(spark, d))
    return records.raw_projection(obs.withColumn("event_timestamp", iso_seconds("event_ts")))


@query("stg_events", f"SELECT {OBS_TIMED} FROM stg")
def stg_events(spark, d):
    return staged_events(spark, d)


@query("stg_metrics", "SELECT * FROM smet")
def stg_metrics(spark, d):
    return staging.stage_metrics(metrics(spark, d))


@query(
    "canonical_label",
    f"""SELECT event_id, anomaly_type, {sql_label('congestion_level')} AS strict_level,
         CASE WHEN trim(congestion_level) = 'Moderate' THEN 'Medium' ELSE {sql_label('congestion_level')} END
           AS aliased_level FROM obs""",
)
def canonical_labels(spark, d):
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        canonical_label("congestion_level").alias("strict_level"),
        canonical_label("congestion_level", aliases={"moderate": "Medium"}).alias("aliased_level"),
    )


@query(
    "label_rank",
    f"""SELECT event_id, anomaly_type, {sql_rank('congestion_level')} AS level_rank,
         {sql_rank('weather', fixed.WEATHER)} AS weather_rank FROM obs""",
)
def label_ranks(spark, d):
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        label_rank("congestion_level").alias("level_rank"),
        label_rank("weather", fixed.WEATHER).alias("weather_rank"),
    )


@query(
    "rank_label",
    """SELECT road_segment_id, lane_count, list_extract(['Low', 'Medium', 'High', 'Severe'], lane_count) AS label
       FROM seg""",
)
def rank_labels(spark, d):
    return segments(spark, d).select("road_segment_id", "lane_count", rank_label("lane_count").alias("label"))


@query(
    "surrogate_keys",
    f"""SELECT event_id, anomaly_type, {sql_key('weather')} AS weather_key, {sql_key('incident_type')} AS incident_key
       FROM obs""",
)
def surrogate_keys(spark, d):
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        surrogate_key("weather").alias("weather_key"),
        surrogate_key("incident_type").alias("incident_key"),
    )


@query(
    "event_key",
    """SELECT road_segment_id, event_ts, generated_at, event_id AS key, left(event_id, 3) AS area_id,
         replace(replace(strftime(event_ts, '%Y-%m-%d'), '-', ''), ':', '') AS compact_day FROM obs""",
)
def event_keys(spark, d):
    return observations(spark, d).select(
        "road_segment_id",
        "event_ts",
        "generated_at",
        event_key("road_segment_id", "event_ts").alias("key"),
        F.substring("road_segment_id", 1, 3).alias("area_id"),
        F.translate(F.to_date("event_ts").cast("string"), "-:", "").alias("compact_day"),
    )


@query(
    "regex_check",
    f"""SELECT road_segment_id, road_name, regexp_matches(road_segment_id, '{fixed.SEGMENT_ID_PATTERN}') AS segment_ok,
         regexp_matches(road_segment_id || '_20260701T081500', '{fixed.EVENT_ID_PATTERN}') AS event_ok,
         regexp_matches(lower(road_segment_id), '{fixed.SEGMENT_ID_PATTERN}') AS lower_ok FROM seg""",
)
def regex_check(spark, d):
    seg = F.col("road_segment_id")
    return segments(spark, d).select(
        seg,
        "road_name",
        seg.rlike(fixed.SEGMENT_ID_PATTERN).alias("segment_ok"),
        F.concat(seg, F.lit("_20260701T081500")).rlike(fixed.EVENT_ID_PATTERN).alias("event_ok"),
        F.lower(seg).rlike(fixed.SEGMENT_ID_PATTERN).alias("lower_ok"),
    )


@query(
    "iso_format",
    f"""SELECT event_id, anomaly_type, {ISO} AS event_timestamp, {ISO_MS} AS generated_text,
         ({ISO}) LIKE '%+05:30' AS has_offset FROM obs""",
)
def iso_format(spark, d):
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        iso_seconds("event_ts").alias("event_timestamp"),
        iso_millis("generated_at").alias("generated_text"),
        iso_seconds("event_ts").endswith(fixed.UTC_OFFSET).alias("has_offset"),
    )


@query(
    "arrival_lag",
    """SELECT event_id, anomaly_type, date_diff('millisecond', event_ts, generated_at)::DOUBLE / 1e3 AS lag_seconds,
         generated_at - INTERVAL 60 SECONDS AS sensed_at FROM obs""",
)
def arrival_lag(spark, d):
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        seconds_between("event_ts", "generated_at").alias("lag_seconds"),
        (F.col("generated_at") - F.expr("INTERVAL 60 SECONDS")).alias("sensed_at"),
    )


@query(
    "date_key",
    f"""SELECT event_id, anomaly_type, {sql_day_key('event_ts')} AS local_day,
         {sql_day_key("event_ts - INTERVAL '5 hours 30 minutes'")} AS utc_day FROM obs""",
)
def date_keys(spark, d):
    """The local day of an event and the UTC day it falls on."""
    utc = F.col("event_ts") - F.expr("INTERVAL '5:30' HOUR TO MINUTE")
    return observations(spark, d).select(
        "event_id",
        "anomaly_type",
        date_key(F.to_date("event_ts")).alias("local_day"),
        date_key(F.to_date(utc)).alias("utc_day"),
    )


@query(
    "calendar_cols",
    """SELECT event_id, anomaly_type, isodow(event_ts) >= 6 AS is_weekend, hour(event_ts)::INT AS hour_of_day,
         strftime(event_ts, '%A') AS day_of_week, strftime(event_ts, '%Y') AS year,
         strftime(event_ts, '%m') AS month, strftime(event_ts, '%d') AS day FROM obs""",
)
def calendar_cols(spark, d):
    parts = calendar_columns("event_ts")
    return observations(spark, d).select("event_id", "anomaly_type", *[v.alias(c) for c, v in parts.items()])


@query(
    "schema_conform",
    """SELECT event_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS event_timestamp,
         CASE WHEN anomaly_type <> 'Delayed' THEN area END AS area, vehicle_count, weather, is_weekend, anomaly_type,
         CASE anomaly_type WHEN 'Delayed' THEN 'zone' WHEN 'nan' THEN 'note,other' ELSE '' END AS undeclared
       FROM obs""",
)
def schema_conform(spark, d):
    """Records in which some rename a field and some add undeclared ones."""
    rows = wire(observations(spark, d))
    kind = F.col("anomaly_type")
    usual = files.message(rows.columns)
    renamed = F.to_json(
        F.struct(*[F.col(c).alias("zone") if c == "area" else F.col(c) for c in reversed(rows.columns)]),
        {"ignoreNullFields": "false"},
    )
    extended = F.to_json(
        F.struct(F.lit(1).alias("other"), *rows.columns, F.lit("x").alias("note")), {"ignoreNullFields": "false"}
    )
    sent = rows.select(F.when(kind == "Delayed", renamed).when(kind == "nan", extended).otherwise(usual).alias("value"))
    return (
        event_contract()
        .conform(sent)
        .select(
            "event_id", "event_timestamp", "area", "vehicle_count", "weather", "is_weekend", "anomaly_type", "undeclared"
        )
    )


@query(
    "union_all_sources",
    """SELECT event_id, area, anomaly_type, vehicle_count, NULL::BIGINT AS total_events, 'raw' AS source FROM obs
       UNION ALL SELECT event_id, area, anomaly_type, vehicle_count, NULL, 'latest' FROM latest
       UNION ALL SELECT NULL, area, NULL, NULL, total_events, 'windows' FROM smet""",
)
def union_all_sources(spark, d):
    columns = ["event_id", "area", "anomaly_type", "vehicle_count"]
    return sets.union_all(
        {
            "raw": observations(spark, d).select(*columns),
            "latest": latest(spark, d).select(*columns),
            "windows": staging.stage_metrics(metrics(spark, d)).select("area", "total_events"),
        }
    )


@query(
    "except_keys",
    "SELECT road_segment_id FROM seg EXCEPT SELECT road_segment_id FROM obs",
)
def except_keys(spark, d):
    return sets.only_in_first(segments(spark, d), observations(spark, d), ["road_segment_id"])


@query(
    "set_equal",
    """SELECT (SELECT count(*) FROM (SELECT event_id FROM valid EXCEPT SELECT event_id FROM stg)) AS only_in_first,
         (SELECT count(*) FROM (SELECT event_id FROM stg EXCEPT SELECT event_id FROM valid)) AS only_in_second,
         (SELECT count(DISTINCT event_id) FROM stg) = (SELECT count(DISTINCT event_id) FROM valid) AS equal""",
)
def set_equal(spark, d):
    stg = staged_events(spark, d)
    return sets.compare_sets(records.clean(stg), stg, ["event_id"])
