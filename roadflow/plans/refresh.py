"""The incremental build: load what is new, rebuild only the days it touched.

An event id carries its event time, so the records of an id normally lie in one day, and a day's facts depend on that
day's rows alone. Where a record was sent again under the same id for another day, the day that has the id so far is
rebuilt as well; an index from ids to days, split by a hash of the id, tells which. Facts of those days are replaced; dimensions are
merged with their tables. Rows outside the plausible ranges are set aside and stop nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions.times import wall_clock
from roadflow.operators.dedup import keep_latest
from roadflow.plans import marts, staging
from roadflow.plans.build import (
    METRIC_SCHEMA,
    METRIC_TABLE_SCHEMA,
    RAW_SCHEMA,
    checked,
    typed_metrics,
    typed_raw,
)
from roadflow.session import staged
from roadflow.sources import ledger
from roadflow.sources.tables import publish, table_name

LOADS = {
    "raw": (RAW_SCHEMA, RAW_SCHEMA, "event_ts", None),
    "metrics": (METRIC_SCHEMA, METRIC_TABLE_SCHEMA, "window_start", {"event_count": "total_events"}),
}
SEGMENT = ["road_segment_id", "area", "road_name", "latitude", "longitude"]
NEWEST = ["generated_at", "event_ts"]
ID_BUCKETS = 64


def load_new(spark: SparkSession, lake: str, warehouse: str) -> None:
    """Load the stream's new files of every table; what was lost is in the ledgers, see ``load_errors``."""
    for name, (given, wanted, time, renames) in LOADS.items():
        ledger.load(
            spark,
            f"{lake}/{name}",
            given,
            f"{warehouse}/{name}",
            wanted,
            f"{warehouse}/ledger/{name}",
            {"event_date": F.to_date(wall_clock(time))},
            ["event_date"],
            renames,
        )


def load_errors(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """Broken or empty files and lost values of all loads of a table."""
    return ledger.errors(spark, f"{warehouse}/ledger/{name}")


def _schema(name: str) -> T.StructType:
    return T.StructType([*LOADS[name][1].fields, T.StructField("event_date", T.DateType())])


def loaded(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A loaded table with its load number (below zero for compacted loads) and day."""
    return ledger.loaded(
        spark, f"{warehouse}/{name}", _schema(name), f"{warehouse}/ledger/{name}", f"{warehouse}/compactions/{name}"
    )


def compact(spark: SparkSession, warehouse: str, layer: str = "marts") -> dict[str, int | None]:
    """Bring the folders of loads that are built into one folder a table, and the index of ids into one file a bucket."""
    done = _built(spark, table_name("builds", layer))
    numbers = {
        name: ledger.compact(
            spark,
            f"{warehouse}/{name}",
            _schema(name),
            f"{warehouse}/ledger/{name}",
            f"{warehouse}/compactions/{name}",
            done[name],
            ["event_date"],
        )
        for name in LOADS
    }
    index = table_name("event_days", layer)
    if spark.catalog.tableExists(index):
        publish(staged(spark.table(index).distinct(), "event_days"), "event_days", layer, partition_by=["id_bucket"])
    return numbers


def _built(spark: SparkSession, builds: str) -> dict[str, int]:
    """The last load of each table that a run has built."""
    if not spark.catalog.tableExists(builds):
        return dict.fromkeys(LOADS, 0)
    return spark.table(builds).agg(*[F.max(n).alias(n) for n in LOADS]).first().asDict()


def touched_days(table: DataFrame, after: int) -> list[date]:
    """Days with rows of later loads; read from the folder names, one value a day."""
    days = table.filter(F.col("load_id") > after).select("event_date").distinct()
    return sorted(r.event_date for r in days.dropna().collect())


def new_ids(table: DataFrame, after: int) -> DataFrame:
    """id_bucket, event_id and day of the rows of later loads; the text of ids is tidied as staging does."""
    rows = staging.stage_events(table.filter(F.col("load_id") > after)).dropna(subset=["event_id", "event_date"])
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(ID_BUCKETS)).cast("int")
    return rows.select(bucket.alias("id_bucket"), "event_id", F.col("event_date").alias("day")).distinct()


def known_days(ids: DataFrame, index: str) -> DataFrame:
    """Entries of the index for the same ids; only the buckets that hold one of them are read, and no fact."""
    spark = ids.sparkSession
    if not spark.catalog.tableExists(index):
        return ids.limit(0)
    wanted = ids.select("id_bucket", "event_id").distinct()
    return spark.table(index).join(wanted, ["id_bucket", "event_id"], "left_semi").select(*ids.columns).distinct()


def drop_days(spark: SparkSession, full: str, days: list[date], present: DataFrame) -> None:
    """Remove the partitions of rebuilt days that have no row left."""
    left = {r.date_key for r in present.select("date_key").distinct().collect()}
    for key in {int(d.strftime("%Y%m%d")) for d in days} - left:
        if spark.catalog.tableExists(full):
            spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION (date_key = {key})")


def merged(new: DataFrame, name: str, layer: str) -> DataFrame:
    """The rows of a published table together with new ones."""
    full = table_name(name, layer)
    spark = new.sparkSession
    return spark.table(full).unionByName(new) if spark.catalog.tableExists(full) else new


def refresh(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    aliases: Mapping[str, str] | None = None,
    layer: str = "marts",
) -> list[date]:
    """Load the stream's new files and rebuild the days they touch; returns those days.

    Rows with a value out of range are published by day as ``events_set_aside``, with the fields at fault; they are
    no facts, and a corrected record takes their place as soon as it comes. The loads that a run has built are recorded
    last, so a run that fails is repeated in full by the next.
    """
    load_new(spark, lake, warehouse)
    builds, index = table_name("builds", layer), table_name("event_days", layer)
    done = _built(spark, builds)
    tables = {name: loaded(spark, warehouse, name) for name in LOADS}
    days = {name: touched_days(table, done[name]) for name, table in tables.items()}
    if not any(days.values()):
        return []
    ids = staged(new_ids(tables["raw"], done["raw"]), "new-ids")
    known = staged(known_days(ids, index), "known-days")
    moved = [r.day for r in known.select("day").distinct().collect()]  # one value a day
    days["raw"] = sorted({*days["raw"], *moved})

    def rows(name: str) -> DataFrame:
        return tables[name].filter(F.col("event_date").isin(days[name])).drop("load_id", "event_date")

    stage, _ = checked(staging.stage_events(typed_raw(rows("raw")), aliases))
    events = staged(marts.latest_events(stage.filter("failed = ''").drop("failed")), "events")
    windows = staged(staging.stage_metrics(typed_metrics(rows("metrics")), aliases), "windows")

    facts = marts.fact_events(events)
    publish(facts, "fact_traffic_events", layer, partition_by=["date_key"])
    drop_days(spark, table_name("fact_traffic_events", layer), days["raw"], facts)
    aside = marts.set_aside(stage.filter("failed <> ''"))
    publish(aside, "events_set_aside", layer, partition_by=["date_key"])
    drop_days(spark, table_name("events_set_aside", layer), days["raw"], aside)
    publish(marts.fact_5min(windows), "fact_traffic_5min", layer, partition_by=["date_key"])
    distinct = {
        "dim_date": marts.dim_date(events, windows),
        "dim_weather": marts.dim_weather(events),
        "dim_incident": marts.dim_incident(events),
    }
    for name, new in distinct.items():
        publish(staged(merged(new, name, layer).distinct(), name), name, layer)
    latest = keep_latest(
        merged(events.select(*SEGMENT, *NEWEST), "segment_latest", layer), ["road_segment_id"], NEWEST
    )
    latest = staged(latest, "segment_latest")
    publish(latest, "segment_latest", layer)
    publish(latest.select(*SEGMENT), "dim_road_segment", layer)

    fresh = ids.join(known, ids.columns, "left_anti").repartition("id_bucket")
    fresh.select("event_id", "day", "id_bucket").write.mode("append").partitionBy("id_bucket").saveAsTable(index)
    loads = [F.lit(spark.read.schema(ledger.LEDGER).parquet(f"{warehouse}/ledger/{n}").agg(F.max("load_id")).first()[0]).alias(n) for n in LOADS]
    spark.range(1).select(*loads).write.mode("append").saveAsTable(builds)
    return sorted(set(days["raw"]) | set(days["metrics"]))
