"""From raw bytes to clean typed events: JSON, event time, missing markers, cleaning, rejects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.functions.labels import canonical_label, lookup, marker_to_null, number_or_null
from roadflow.functions.times import event_instant

TEXT_MARKER_COLUMNS = ("incident_type", "anomaly_type")


def flatten_json(raw: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Bytes or text holding one JSON object per row, as flat typed columns; each record is parsed once."""
    return raw.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), schema))))


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with their columns fixed here.

    A filter on derived columns is otherwise pushed below the projection that derives them, and both then
    evaluate the same expressions; a filter cannot pass a generator whose output it reads.
    """
    return df.select(F.inline(F.array(F.struct("*"))))


def json_status(value: Column) -> Column:
    """'ok', 'not_utf8' or 'not_json' for bytes or text that should hold a JSON object."""
    text = value.cast("string")
    parsed = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
    return (
        F.when(~F.is_valid_utf8(text), "not_utf8")
        .when(parsed.isNull(), "not_json")
        .otherwise("ok")
    )


def split_dead_letters(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(readable rows, unreadable rows with a ``reason``); no row is lost."""
    judged = raw.withColumn("reason", json_status(F.col(value)))
    return judged.filter("reason = 'ok'").drop("reason"), judged.filter("reason <> 'ok'")


def with_event_time(df: DataFrame, source: str = "event_timestamp", target: str = "event_ts") -> DataFrame:
    return df.withColumn(target, event_instant(source))


def with_missing_markers_removed(
    df: DataFrame, columns: Iterable[str] = TEXT_MARKER_COLUMNS, lenient: bool = False
) -> DataFrame:
    """Missing-value markers to NULL; ``lenient`` widens it to every text form and to NaN numbers."""
    changes = {c: marker_to_null(c, lenient=lenient) for c in columns}
    if lenient:
        changes |= {f.name: number_or_null(f.name) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(changes)


def cleaning_rules(levels: Iterable[str] = fixed.RANKED_LEVELS) -> dict[str, Column]:
    """Rule code to the condition a row must meet; a NULL condition counts as not met."""
    present = ["event_id", "event_ts", "area", "road_segment_id"]
    rules = {f"{c}_missing": F.col(c).isNotNull() for c in present}
    rules |= {f"{c}_negative": F.col(c) >= 0 for c in ("vehicle_count", "avg_speed_kmph")}
    rules["occupancy_out_of_range"] = F.col("occupancy_pct").between(0, 100)
    rules["unknown_level"] = F.col("congestion_level").isin(list(levels))
    return rules


def with_level_aliases(df: DataFrame, aliases: Mapping[str, str] | None) -> DataFrame:
    """Rename congestion levels before cleaning, e.g. {"Moderate": "Medium"}."""
    if not aliases:
        return df
    return df.withColumn("congestion_level", lookup("congestion_level", aliases, F.col("congestion_level")))


def clean(
    df: DataFrame, levels: Iterable[str] = fixed.RANKED_LEVELS, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows that meet every cleaning rule."""
    keep = F.lit(True)
    for condition in cleaning_rules(levels).values():
        keep = keep & condition
    return with_level_aliases(df, aliases).filter(keep)


def rejected(
    df: DataFrame, levels: Iterable[str] = fixed.RANKED_LEVELS, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows that cleaning drops, with every reason in ``reasons``."""
    failures = {code: ~F.coalesce(ok, F.lit(False)) for code, ok in cleaning_rules(levels).items()}
    return failing(with_level_aliases(df, aliases), failures, "reasons")


def failed_codes(failures: Mapping[str, Column]) -> Column:
    """Comma-joined codes of the conditions that are true; empty text when none is.

    Of an array, because a long list of rules in one text function would become one generated method that the JVM
    leaves uncompiled.
    """
    codes = [F.when(condition, F.lit(code)) for code, condition in failures.items()]
    return F.array_join(F.array_compact(F.array(*codes)), ",")


def failing(df: DataFrame, failures: Mapping[str, Column], target: str) -> DataFrame:
    """Rows for which a condition is true, with the codes of all that are; the rules are evaluated once."""
    return computed_once(df.withColumn(target, failed_codes(failures))).filter(F.col(target) != "")


def raw_projection(df: DataFrame) -> DataFrame:
    """The cleaned-event columns of the raw lake, in their fixed order."""
    at = fixed.EVENT_COLUMNS.index("event_timestamp") + 1
    return df.select(*fixed.EVENT_COLUMNS[:at], "event_ts", *fixed.EVENT_COLUMNS[at:])


def with_canonical_level(df: DataFrame, column: str = "congestion_level", **options) -> DataFrame:
    return df.withColumn(column, canonical_label(column, **options))
