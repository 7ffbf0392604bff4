"""File readers and writers: CSV, JSON lines, Hive-partitioned Parquet, keyed JSON, city configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.sources.contract import EVENT_SCHEMA

PARTITIONED_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in fixed.PARTITION_COLUMNS if c != "area"]
)

_PROFILE = "struct<weekday: array<double>, weekend: array<double>>"
CITY_SCHEMA = (
    "day_of_week_multiplier map<string, double>, monthly_rain_spells_per_day map<string, double>, "
    f"area_type_hourly_profiles map<string, {_PROFILE}>, "
    "areas array<struct<area_id: string, area_name: string, area_type: string, center_latitude: double, "
    "center_longitude: double, peak_demand_ratio: double, description: string>>"
)


def read_csv_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """CSV files with a header; empty fields are NULL and the text None stays a value."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def read_json_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_partitioned_events(
    spark: SparkSession, path: str, schema: T.StructType = PARTITIONED_SCHEMA
) -> DataFrame:
    """Hive-partitioned Parquet; the declared text type keeps a month such as 07 as written."""
    return spark.read.schema(schema).parquet(path)


def write_text_events(df: DataFrame, path: str, kind: str, max_rows: int = 1_000_000, overwrite: bool = False) -> None:
    """CSV or JSON lines in files of at most ``max_rows`` rows; existing output is kept unless asked."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("maxRecordsPerFile", max_rows)
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown text format {kind!r}")


def write_partitioned_events(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = tuple(fixed.PARTITION_COLUMNS),
    max_rows: int = 1_000_000,
    overwrite: bool = False,
) -> None:
    """Hive-partitioned Parquet.

    Rows are brought together by partition plus a spread over each partition, whose width follows from the
    data size: adaptive execution merges the small pieces and splits the large ones, so a day and area that
    holds a third of all rows is still written by many tasks.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite" if overwrite else "errorifexists")
        .partitionBy(*columns)
        .option("maxRecordsPerFile", max_rows)
        .parquet(path)
    )


def write_metadata(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A small dimension as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path)


def message(columns: list[str] | None = None) -> Column:
    """One JSON object per row, with NULL fields written out."""
    row = F.struct("*") if columns is None else F.struct(*columns)
    return F.to_json(row, {"ignoreNullFields": "false"})


def keyed_json(df: DataFrame, key: str = "road_segment_id") -> DataFrame:
    """(key, value) rows ready for a topic."""
    return df.select(F.col(key).cast("string").alias("key"), message(df.columns).alias("value"))


def read_city(spark: SparkSession, path: str) -> DataFrame:
    """City configuration as its one nested row."""
    return spark.read.schema(CITY_SCHEMA).option("multiLine", True).json(path)


def city_areas(city: DataFrame) -> DataFrame:
    return city.select(F.explode("areas").alias("a")).select("a.*")


def city_profiles(city: DataFrame) -> DataFrame:
    """(area_type, day_kind, hourly array) rows."""
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("day_kind"), F.col(f"profile.{k}").alias("hourly"))
            for k in ("weekday", "weekend")
        ]
    )
    return (
        city.select(F.explode("area_type_hourly_profiles").alias("area_type", "profile"))
        .select("area_type", F.explode(kinds).alias("p"))
        .select("area_type", "p.*")
    )


def profile_hours(profiles: DataFrame) -> DataFrame:
    """(area_type, day_kind, hour, value) rows of profile arrays."""
    return profiles.select("area_type", "day_kind", F.posexplode("hourly").alias("hour", "value"))


def city_factors(city: DataFrame, column: str, key: str = "name", value: str = "factor") -> DataFrame:
    """Rows of one of the configuration's maps, e.g. the day-of-week multipliers."""
    return city.select(F.explode(column).alias(key, value))
