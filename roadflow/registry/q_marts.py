"""Queries on deduplication, window metrics, the star schema and ordered sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roadflow.functions import fixed
from roadflow.operators import dedup, joins, sequences, windows
from roadflow.operators.quality import detect_anomalies
from roadflow.plans import build, layout, marts
from roadflow.registry.catalog import (
    DECIMALS,
    latest,
    metrics,
    query,
    sql_metrics,
    sql_only,
    sql_rank,
    sql_unrank,
    staged_events,
    staged_metrics,
    valid_events,
)
from roadflow.registry.observations import observations, segments
from roadflow.session import scratch_path, staged


@query("dedup_latest", "SELECT * FROM latest")
def dedup_latest(spark, d):
    return latest(spark, d)


@query("dedup_first", "SELECT * FROM earliest")
def dedup_first(spark, d):
    return dedup.keep_first(valid_events(spark, d))


@query("win5_agg", "SELECT * FROM met")
def win5_agg(spark, d):
    return metrics(spark, d)


@query("win5_by_segment", sql_metrics("earliest", "area, road_segment_id"))
def win5_by_segment(spark, d):
    first = dedup.keep_first(valid_events(spark, d))
    return windows.window_metrics(first, ["area", "road_segment_id"], decimals=DECIMALS)


@query("win5_recompute", sql_metrics("latest"))
def win5_recompute(spark, d):
    return windows.window_metrics(latest(spark, d), decimals=DECIMALS)


@query(
    "peak_level",
    f"""SELECT area, day, r AS peak_congestion_rank, {sql_unrank('r')} AS peak_congestion_level FROM (
         SELECT area, CAST(event_ts AS DATE) AS day, max({sql_rank('congestion_level')})::INT AS r FROM stg
         GROUP BY ALL)""",
)
def peak_level(spark, d):
    return windows.peak_level(staged_events(spark, d).withColumn("day", F.to_date("event_ts")), ["area", "day"])


@query("dim_date", "SELECT * FROM dim_date")
def dim_date(spark, d):
    return marts.dim_date(latest(spark, d), staged_metrics(spark, d))


@query("dim_road_segment", "SELECT * FROM dim_segment")
def dim_road_segment(spark, d):
    return marts.dim_road_segment(latest(spark, d))


@query("dim_weather", "SELECT * FROM dim_weather")
def dim_weather(spark, d):
    return marts.dim_weather(latest(spark, d))


@query("dim_incident", "SELECT * FROM dim_incident")
def dim_incident(spark, d):
    return marts.dim_incident(latest(spark, d))


@query("fact_events", "SELECT * FROM fact_events")
def fact_events(spark, d):
    return marts.fact_events(latest(spark, d))


@query("fact_5min", "SELECT * FROM fact_5min")
def fact_5min(spark, d):
    return marts.fact_5min(staged_metrics(spark, d))


@query(
    "star_join_events",
    """SELECT f.*, t.* EXCLUDE (date_key), s.area, s.road_name, s.latitude, s.longitude, w.weather, i.incident_type
       FROM fact_events f LEFT JOIN dim_date t USING (date_key) LEFT JOIN dim_segment s USING (road_segment_id)
       LEFT JOIN (SELECT weather_key, min(weather) AS weather FROM dim_weather GROUP BY 1) w USING (weather_key)
       LEFT JOIN (SELECT incident_key, min(incident_type) AS incident_type FROM dim_incident GROUP BY 1) i
         USING (incident_key)""",
)
def star_join_events(spark, d):
    return build.models(valid_events(spark, d), metrics(spark, d)).star_events()


@query(
    "star_join_5min",
    """SELECT f.*, t.* EXCLUDE (date_key), s.area AS road_segment_id_area, s.road_name AS road_segment_id_road_name,
         s.latitude, s.longitude
       FROM fact_5min f LEFT JOIN dim_date t USING (date_key) LEFT JOIN dim_segment s USING (road_segment_id)""",
)
def star_join_5min(spark, d):
    return build.models(valid_events(spark, d), metrics(spark, d)).star_5min()


@query(
    "semi_dups",
    """SELECT event_id, generated_at, vehicle_count FROM obs WHERE anomaly_type = 'Duplicate'
         AND event_id IN (SELECT event_id FROM obs WHERE anomaly_type <> 'Duplicate')""",
)
def semi_dups(spark, d):
    obs = observations(spark, d)
    copies, originals = obs.filter("anomaly_type = 'Duplicate'"), obs.filter("anomaly_type <> 'Duplicate'")
    return joins.rows_in_set(copies, originals, "event_id").select("event_id", "generated_at", "vehicle_count")


COMPARED = [c for c in fixed.EVENT_COLUMNS if c not in ("event_id", "event_timestamp", "generated_at", "anomaly_type")]


@query(
    "dup_vs_original",
    f"""SELECT c.event_id, count(DISTINCT c.generated_at) AS copies, count(DISTINCT o.generated_at) AS originals,
         bool_and({' AND '.join(f'c.{x} IS NOT DISTINCT FROM o.{x}' for x in COMPARED)}) AS same_values,
         bool_and(c.generated_at > o.generated_at) AS copies_later
       FROM obs c JOIN obs o USING (event_id) WHERE c.anomaly_type = 'Duplicate' AND o.anomaly_type <> 'Duplicate'
       GROUP BY 1""",
)
def dup_vs_original(spark, d):
    return dedup.copies_against_originals(observations(spark, d), COMPARED)


_REDELIVERED = "SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE congestion_level = 'High'"


def redelivered(spark, d):
    """Observations of which those at one level came a second time, unchanged in every byte."""
    obs = observations(spark, d)
    return obs.unionByName(obs.filter("congestion_level = 'High'"))


@query(
    "repeated_deliveries",
    f""", sent AS ({_REDELIVERED})
       SELECT event_id, count(*) AS deliveries,
         {' AND '.join(f'count(DISTINCT {x}) + max(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) <= 1' for x in COMPARED)}
           AS same_values,
         date_diff('millisecond', min(generated_at), max(generated_at))::DOUBLE / 1e3 AS seconds
       FROM sent GROUP BY 1 HAVING count(*) > 1""",
)
def repeated_deliveries(spark, d):
    return dedup.repeated_deliveries(redelivered(spark, d), COMPARED)


@query(
    "redelivered_duplicates",
    f""", sent AS ({_REDELIVERED})
       SELECT event_id, rn > 1 AS duplicate, count(*) AS n FROM (
         SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY generated_at) AS rn FROM sent)
       GROUP BY ALL""",
)
def redelivered_duplicates(spark, d):
    """Rows of each id that are labelled as duplicates, and that are not: one a key, however often it came."""
    found = detect_anomalies(redelivered(spark, d))
    label = F.coalesce(F.array_contains(F.split("detected", ","), "Duplicate"), F.lit(False))
    return found.groupBy("event_id", label.alias("duplicate")).agg(F.count(F.lit(1)).alias("n"))


GAP_SQL = """SELECT road_segment_id, event_ts, n AS observations, previous_ts,
         date_diff('second', previous_ts, event_ts)::DOUBLE AS gap_seconds
       FROM (SELECT *, lag(event_ts) OVER (PARTITION BY road_segment_id ORDER BY event_ts) AS previous_ts
         FROM (SELECT road_segment_id, event_ts, count(*) AS n FROM obs GROUP BY ALL))"""


@query("obs_gap", GAP_SQL)
def obs_gap(spark, d):
    return sequences.observation_gaps(observations(spark, d))


@query(
    "order_inversions",
    """SELECT road_segment_id, count(*) AS observations, count(CASE WHEN event_ts < before THEN 1 END) AS inversions
       FROM (SELECT *, lag(event_ts) OVER (PARTITION BY road_segment_id ORDER BY generated_at, event_ts) AS before
         FROM obs) GROUP BY 1""",
)
def order_inversions(spark, d):
    return sequences.order_inversions(observations(spark, d))


EPISODE_SQL = """SELECT road_segment_id, episode, any_value(incident_type) AS incident_type, min(event_ts) AS start_ts,
         max(event_ts) AS end_ts, sum(n)::BIGINT AS observations
       FROM (SELECT *, sum(change) OVER (PARTITION BY road_segment_id ORDER BY event_ts, incident_type NULLS FIRST
           ROWS UNBOUNDED PRECEDING)::BIGINT AS episode
         FROM (SELECT *, CASE WHEN row_number() OVER w > 1 AND incident_type IS NOT DISTINCT FROM
             lag(incident_type) OVER w THEN 0 ELSE 1 END AS change
           FROM (SELECT road_segment_id, event_ts, incident_type, count(*) AS n FROM stg GROUP BY ALL)
           WINDOW w AS (PARTITION BY road_segment_id ORDER BY event_ts, incident_type NULLS FIRST)))
       GROUP BY 1, 2"""


@query("incident_episodes", EPISODE_SQL)
def incident_episodes(spark, d):
    return sequences.episodes(staged_events(spark, d), ["incident_type"])


def laid_out(events, name):
    """Events as a table by segment and day; its files are in the shared folder, so its name is only needed to plan."""
    spark, layer = events.sparkSession, f"layout_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return layout.write_by_segment(events, "events", buckets, layer, scratch_path(spark, name)), layer


def read_laid_out(events, name, read):
    """What ``read`` gives of the laid-out events."""
    spark = events.sparkSession
    full, layer = laid_out(events, name)
    found = read(spark, full)
    spark.sql(f"DROP DATABASE {layer} CASCADE")
    return found


@query("obs_gap_by_layout", GAP_SQL)
def obs_gap_by_layout(spark, d):
    return read_laid_out(observations(spark, d), "gaps", layout.gaps)


@query("incident_episodes_by_layout", EPISODE_SQL)
def incident_episodes_by_layout(spark, d):
    events = staged_events(spark, d)
    return read_laid_out(events, "episodes", lambda spark, full: layout.episodes(spark, full, ["incident_type"]))


@query("segment_latest_by_layout", "SELECT * FROM dim_segment")
def segment_latest_by_layout(spark, d):
    return read_laid_out(latest(spark, d), "segments", layout.segment_latest)


@query(
    "missing_observations",
    """SELECT road_segment_id, step FROM (SELECT DISTINCT road_segment_id FROM obs),
         (SELECT unnest(generate_series(min(time_bucket(INTERVAL 60 MINUTES, event_ts)),
           max(time_bucket(INTERVAL 60 MINUTES, event_ts)), INTERVAL 60 MINUTES)) AS step FROM obs)
       EXCEPT SELECT road_segment_id, time_bucket(INTERVAL 60 MINUTES, event_ts) FROM obs""",
)
def missing_observations(spark, d):
    return sequences.missing_observations(observations(spark, d), 60)


@query(
    "topn_per_group",
    f"""SELECT area, road_segment_id, road_name, lane_count, position::INT AS position FROM (SELECT *, row_number()
         OVER (PARTITION BY area ORDER BY road_segment_id) AS position FROM seg) WHERE position <= 10""",
)
def topn_per_group(spark, d):
    """The first ten segments of each area in key order."""
    ranked = sequences.first_per_group(segments(spark, d), ["area"], ["road_segment_id"], 10)
    return ranked.select("area", "road_segment_id", "road_name", "lane_count", "position")


@query(
    "cumulative_volume",
    """SELECT area, day, hour, vehicles, running_vehicles, running_vehicles::DOUBLE / nullif(sum(vehicles) OVER
         (PARTITION BY area, day), 0)::DOUBLE AS day_share
       FROM (SELECT *, (sum(vehicles) OVER (PARTITION BY area, day ORDER BY hour))::BIGINT AS running_vehicles
         FROM (SELECT area, CAST(event_ts AS DATE) AS day, hour(event_ts)::INT AS hour,
           sum(vehicle_count)::BIGINT AS vehicles FROM latest GROUP BY ALL))""",
)
def cumulative_volume(spark, d):
    return sequences.cumulative_volume(latest(spark, d))


@query(
    "arrival_order",
    "SELECT generated_at, event_id, anomaly_type, event_ts, vehicle_count FROM obs ORDER BY generated_at, event_id",
)
def arrival_order(spark, d):
    columns = ["generated_at", "event_id", "anomaly_type", "event_ts", "vehicle_count"]
    return sequences.arrival_order(observations(spark, d).select(*columns))


@query(
    "first_n_arrivals",
    """SELECT generated_at, event_id, anomaly_type, vehicle_count FROM obs
       ORDER BY generated_at, event_id, anomaly_type, vehicle_count LIMIT 500""",
)
def first_n_arrivals(spark, d):
    columns = ["generated_at", "event_id", "anomaly_type", "vehicle_count"]
    return sequences.first_arrivals(observations(spark, d).select(*columns), 500)


# ---- the same operators on the large order tables ----------------------------------------------
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query(
    "shipment_latest",
    sql_only("l_orderkey, l_linenumber", ", ".join(f"{c} DESC NULLS LAST" for c in ["l_shipdate", *LINE_REST]), "lineitem"),
)
def shipment_latest(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return dedup.keep_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", *LINE_REST])


@query(
    "shipment_windows",
    """SELECT time_bucket(INTERVAL 7 DAYS, l_shipdate, TIMESTAMP '1970-01-01') AS window_start, l_returnflag,
         count(*) AS lines, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY ALL""",
)
def shipment_windows(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    grouped = lines.groupBy(F.window("l_shipdate", "7 days").alias("w"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    return grouped.select(F.col("w.start").alias("window_start"), "l_returnflag", "lines", "quantity")


@query(
    "shipment_star",
    """SELECT year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, p_brand, s_nationkey,
         count(*) AS lines, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       GROUP BY ALL""",
)
def shipment_star(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    parts = spark.read.parquet(f"{d}/part.parquet").withColumnRenamed("p_partkey", "l_partkey")
    suppliers = spark.read.parquet(f"{d}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey")
    days = staged(marts.dim_date(lines.select(F.col("l_shipdate").alias("event_ts"))), "ship-days")
    keyed = lines.withColumn("date_key", marts.date_key(F.to_date("l_shipdate")))
    star = joins.star_join(
        keyed,
        {
            "l_partkey": parts.select("l_partkey", "p_brand"),
            "l_suppkey": suppliers.select("l_suppkey", "s_nationkey"),
            "date_key": days.select("date_key", "year", "month"),
        },
    )
    return star.groupBy("year", "month", "p_brand", "s_nationkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
