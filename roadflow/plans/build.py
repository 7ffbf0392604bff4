"""The batch build: load, stage, deduplicate, build the marts, check; a broken check fails the build."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.functions.times import local_event_time, wall_clock
from roadflow.operators.joins import one_per_key, star_join
from roadflow.operators.quality import range_rules
from roadflow.operators.records import failed_codes
from roadflow.plans import marts, staging
from roadflow.session import staged
from roadflow.sources.contract import EVENT_SCHEMA
from roadflow.sources import ledger
from roadflow.sources.tables import publish

RAW_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("event_ts", T.TimestampType())])
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("area", T.StringType()),
        T.StructField("road_segment_id", T.StringType()),
        T.StructField("road_name", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("avg_vehicle_count", T.DoubleType()),
        T.StructField("avg_speed_kmph", T.DoubleType()),
        T.StructField("avg_occupancy_pct", T.DoubleType()),
        T.StructField("peak_congestion_rank", T.IntegerType()),
        T.StructField("peak_congestion_level", T.StringType()),
    ]
)
METRIC_TABLE_SCHEMA = T.StructType(
    [T.StructField("total_events", T.LongType()) if f.name == "event_count" else f for f in METRIC_SCHEMA]
)


class BuildError(RuntimeError):
    """A data test found failing rows."""


@dataclass(frozen=True)
class Marts:
    events: DataFrame
    metrics: DataFrame
    dim_date: DataFrame
    dim_road_segment: DataFrame
    dim_weather: DataFrame
    dim_incident: DataFrame
    fact_events: DataFrame
    fact_5min: DataFrame

    def star_events(self) -> DataFrame:
        """Event fact with the attributes of its four dimensions."""
        dims = {
            "date_key": self.dim_date,
            "road_segment_id": self.dim_road_segment,
            "weather_key": one_per_key(self.dim_weather, "weather_key"),
            "incident_key": one_per_key(self.dim_incident, "incident_key"),
        }
        return star_join(self.fact_events, dims)

    def star_5min(self) -> DataFrame:
        """Window fact with the attributes of the two dimensions it shares."""
        return star_join(self.fact_5min, {"date_key": self.dim_date, "road_segment_id": self.dim_road_segment})


def checked(stage: DataFrame) -> tuple[DataFrame, int]:
    """Staged events, written once with the fields out of range in ``failed`` (empty when none is), and how many rows fail.

    The count is observed by the write itself, so the test needs no scan of its own.
    """
    counted = Observation()
    failed = stage.withColumn("failed", failed_codes(range_rules()))
    written = staged(failed.observe(counted, F.count(F.when(F.col("failed") != "", 1)).alias("n")), "stage")
    return written, counted.get["n"]


def models(raw_events: DataFrame, metrics: DataFrame, aliases: Mapping[str, str] | None = None) -> Marts:
    """All models over raw events and window metrics.

    Several models read the deduplicated events and the windows, so those are written once; the dimensions are written
    too, which gives joins with them a known size.
    """
    return models_of(staging.stage_events(raw_events, aliases), staging.stage_metrics(metrics, aliases))


def models_of(stage: DataFrame, stage_metrics: DataFrame) -> Marts:
    """All models over staged events and staged window metrics."""
    events = staged(marts.latest_events(stage), "events")
    windows = staged(stage_metrics, "windows")
    return Marts(
        events=events,
        metrics=windows,
        dim_date=staged(marts.dim_date(events, windows), "dim_date"),
        dim_road_segment=staged(marts.dim_road_segment(events), "dim_road_segment"),
        dim_weather=staged(marts.dim_weather(events), "dim_weather"),
        dim_incident=staged(marts.dim_incident(events), "dim_incident"),
        fact_events=marts.fact_events(events),
        fact_5min=marts.fact_5min(windows),
    )


def typed_raw(raw: DataFrame, zone: str = fixed.TIME_ZONE) -> DataFrame:
    """Stored raw events with both times as local wall-clock time, so that days are days of the road."""
    return raw.withColumns(
        {"event_ts": wall_clock("event_ts", zone), "generated_at": local_event_time("generated_at", zone)}
    )


def typed_metrics(metrics: DataFrame, zone: str = fixed.TIME_ZONE) -> DataFrame:
    return metrics.withColumns({c: wall_clock(c, zone) for c in ("window_start", "window_end")})


def load_then_build(
    spark: SparkSession, lake: str, warehouse: str, aliases: Mapping[str, str] | None = None, **options
) -> Marts:
    """One run of the batch job: load the files that the stream added since the last run, then build.

    ``lake`` holds the stream's raw and metrics folders, ``warehouse`` the loaded tables, their ledgers, and in
    ``load_errors`` by table what the loads left out.
    """
    loads = {
        "raw": (RAW_SCHEMA, RAW_SCHEMA, None),
        "metrics": (METRIC_SCHEMA, METRIC_TABLE_SCHEMA, {"event_count": "total_events"}),
    }
    tables = {}
    for name, (given, wanted, renames) in loads.items():
        target, known = f"{warehouse}/{name}", f"{warehouse}/ledger/{name}"
        ledger.load(spark, f"{lake}/{name}", given, target, wanted, known, renames=renames)
        ledger.errors(spark, known).write.mode("overwrite").parquet(f"{warehouse}/load_errors/{name}")
        tables[name] = ledger.loaded(spark, target, wanted, known, f"{warehouse}/compactions/{name}").drop("load_id")
    return build(typed_raw(tables["raw"]), typed_metrics(tables["metrics"]), aliases, **options)


def build(
    raw_events: DataFrame,
    metrics: DataFrame,
    aliases: Mapping[str, str] | None = None,
    stop_on_violation: bool = True,
) -> Marts:
    """Run the range test, then publish staging and intermediate models as views and the marts as tables.

    A failing test leaves what was published before as it is. Facts are replaced as a whole: days that the input no
    longer has are gone.
    """
    written, failing = checked(staging.stage_events(raw_events, aliases))
    if stop_on_violation and failing:
        raise BuildError(f"{failing} events outside the plausible ranges; see range_violations()")
    stage = written.drop("failed")
    built = models_of(stage, staging.stage_metrics(metrics, aliases))
    publish(stage, "stg_traffic_events", "staging", "view")
    publish(built.metrics, "stg_traffic_metrics_5min", "staging", "view")
    publish(built.events, "int_traffic_events_deduplicated", "intermediate", "view")
    for name in ("dim_date", "dim_road_segment", "dim_weather", "dim_incident"):
        publish(getattr(built, name), name, "marts")
    publish(built.fact_events, "fact_traffic_events", "marts", partition_by=["date_key"], whole=True)
    publish(built.fact_5min, "fact_traffic_5min", "marts", partition_by=["date_key"], whole=True)
    return built
