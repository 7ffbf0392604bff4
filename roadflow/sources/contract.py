"""The event contract: declared fields, their Spark schema, and the rules they imply as Columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.functions import fixed
from roadflow.functions.times import event_instant
from roadflow.operators.records import failed_codes, failing

SPARK_TYPES = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
}
# JSON value kinds that satisfy a declared type, and how such a value is read; an integer is a number
# without a fraction, however it is written.
NUMBER_KINDS = ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"]
JSON_KINDS = {"string": ["STRING"], "number": NUMBER_KINDS, "integer": NUMBER_KINDS, "boolean": ["BOOLEAN"]}
JSON_READS = SPARK_TYPES | {"integer": T.DoubleType()}


@dataclass(frozen=True)
class Field:
    """One declared field and what its values must satisfy."""

    name: str
    kind: str = "string"
    nullable: bool = False
    enum: tuple = ()
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    const: Any = None
    date_time: bool = False

    def value_failures(self, value: Column) -> dict[str, Column]:
        """Code to failure condition for a typed value; NULL values fail none of them."""
        failures = {}
        if self.enum:
            failures["enum"] = ~value.isin(list(self.enum))
        if self.pattern:
            failures["pattern"] = ~value.rlike(self.pattern)
        if self.minimum is not None:
            failures["minimum"] = value < self.minimum
        if self.maximum is not None:
            failures["maximum"] = value > self.maximum
        if self.const is not None:
            failures["const"] = value != self.const
        if self.date_time:
            known = event_instant(value).isNotNull()
            failures["format"] = value.isNotNull() & ~known
            failures["offset"] = known & ~value.endswith(fixed.UTC_OFFSET)
        return {f"{code}:{self.name}": condition for code, condition in failures.items()}


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    required: frozenset[str] = frozenset()
    closed: bool = True  # undeclared fields are not allowed
    partitioning: tuple[str, ...] = field(default_factory=tuple)
    across: Callable[[Callable[[str], Column]], dict[str, Column]] | None = None  # rules on several fields
    needs: tuple[str, ...] = ()  # the fields they read

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, SPARK_TYPES[f.kind], True) for f in self.fields])

    def failures(self, df: DataFrame) -> dict[str, Column]:
        """Rules over typed columns; a missing column counts as NULL."""
        rules = {}
        for f in self.fields:
            if f.name not in df.columns:
                rules |= {f"missing:{f.name}": F.lit(f.name in self.required)}
                continue
            value = F.col(f.name)
            if not f.nullable:
                rules[f"null:{f.name}"] = value.isNull()
            rules |= f.value_failures(value)
        if self.across and set(self.needs) <= set(df.columns):
            rules |= self.across(F.col)
        return rules

    def violations(self, df: DataFrame, target: str = "violations") -> DataFrame:
        """Rows of typed columns that break the contract, with the codes of all broken rules."""
        return failing(df, self.failures(df), target)

    def json_violations(self, raw: DataFrame, value: str = "value", target: str = "violations") -> DataFrame:
        """Raw JSON rows with the codes of all broken rules; empty text for a valid record.

        Works on the document itself, so an absent field, a null, a value of another type and an undeclared
        field are told apart. The text is parsed once, into a variant; kinds, names and typed values come from that.
        """
        rows = raw.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col(value).cast("string")).alias("_doc")))))
        nodes = [F.try_variant_get("_doc", F.lit(f"$.{f.name}"), "variant") for f in self.fields]
        typed = [
            F.try_variant_get("_doc", F.lit(f"$.{f.name}"), JSON_READS[f.kind].simpleString()).alias(f.name)
            for f in self.fields
        ]
        entries = F.try_variant_get("_doc", F.lit("$"), "map<string, variant>")
        rows = rows.select(
            *raw.columns,
            "_doc",
            F.map_keys(entries).alias("_keys"),
            F.struct(*typed).alias("_typed"),
            F.transform(F.array(*nodes), lambda node: F.regexp_replace(F.schema_of_variant(node), r"\(.*", "")).alias("_kinds"),
        )
        readable = F.col("_doc").isNotNull() & F.col("_keys").isNotNull()
        rules: dict[str, Column] = {"not_an_object": ~readable}
        for i, f in enumerate(self.fields):
            kind, found = F.col("_kinds")[i], F.col(f"_typed.{f.name}")
            if f.name in self.required:
                rules[f"missing:{f.name}"] = readable & kind.isNull()
            if not f.nullable:
                rules[f"null:{f.name}"] = kind == "VOID"
            fits = kind.isin(JSON_KINDS[f.kind])
            if f.kind == "integer":
                fits = fits & (found == F.floor(found))
            rules[f"type:{f.name}"] = (kind != "VOID") & ~fits
            rules |= {code: fits & failure for code, failure in f.value_failures(found).items()}
        if self.closed:
            rules["undeclared"] = F.size(F.array_except("_keys", F.array(*[F.lit(n) for n in self.names]))) > 0
        if self.across:
            rules |= self.across(lambda name: F.col(f"_typed.{name}"))
        return rows.withColumn(target, failed_codes(rules)).drop("_doc", "_keys", "_typed", "_kinds")

    def conform(self, raw: DataFrame, value: str = "value") -> DataFrame:
        """Raw JSON rows as the declared columns in declared order: absent ones NULL, and the names of
        undeclared ones in ``undeclared``."""
        text = F.col(value).cast("string")
        declared = F.array(*[F.lit(n) for n in self.names])
        extra = F.array_sort(F.array_except(F.json_object_keys(text), declared))
        return raw.select(
            F.from_json(text, self.schema()).alias("_record"), F.array_join(extra, ",").alias("undeclared")
        ).select("_record.*", "undeclared")


def event_rules(value: Callable[[str], Column]) -> dict[str, Column]:
    """Rules that tie an event's fields together; fields that are not what they should be break none of them.

    A record is made after the event, and its id is its segment and its local time.
    """
    time = value("event_timestamp")
    key = F.concat(value("road_segment_id"), F.lit("_"), F.translate(F.left(time, F.lit(19)), "-:", ""))
    return {
        "order:generated_at": event_instant(value("generated_at")) <= event_instant(time),
        "key:event_id": event_instant(time).isNotNull() & (value("event_id") != key),
    }


def event_contract(**overrides: Field) -> Contract:
    """The traffic event contract; a keyword replaces the field of that name."""
    nullable = set(fixed.OPTIONAL_COLUMNS)
    declared = {
        "event_id": {"pattern": fixed.EVENT_ID_PATTERN},
        "event_timestamp": {"date_time": True},
        "area": {"enum": tuple(fixed.AREAS.values())},
        "road_segment_id": {"pattern": fixed.SEGMENT_ID_PATTERN},
        "latitude": {"kind": "number", "minimum": fixed.LATITUDE_BOX[0], "maximum": fixed.LATITUDE_BOX[1]},
        "longitude": {"kind": "number", "minimum": fixed.LONGITUDE_BOX[0], "maximum": fixed.LONGITUDE_BOX[1]},
        "vehicle_count": {"kind": "integer", "minimum": 0},
        "avg_speed_kmph": {"kind": "number", "minimum": 0},
        "occupancy_pct": {"kind": "number", "minimum": 0, "maximum": 100},
        "congestion_level": {"enum": tuple(fixed.SCORED_LEVELS)},
        "weather": {"enum": tuple(fixed.WEATHER)},
        "incident_type": {"enum": tuple(fixed.INCIDENTS)},
        "incident_duration_minutes": {"kind": "integer", "minimum": 0},
        "is_weekend": {"kind": "boolean"},
        "hour_of_day": {"kind": "integer", "minimum": 0, "maximum": 23},
        "day_of_week": {"enum": tuple(fixed.DAY_NAMES)},
        "data_source": {"const": fixed.DATA_SOURCE},
        "generated_at": {"date_time": True},
        "anomaly_type": {"enum": tuple(fixed.ANOMALIES)},
    }
    fields = [Field(name=c, nullable=c in nullable, **declared.get(c, {})) for c in fixed.EVENT_COLUMNS]
    return Contract(
        fields=tuple(overrides.get(f.name, f) for f in fields),
        required=frozenset(fixed.EVENT_COLUMNS),
        partitioning=tuple(fixed.PARTITION_COLUMNS),
        across=event_rules,
        needs=("event_id", "road_segment_id", "event_timestamp", "generated_at"),
    )


EVENT_SCHEMA = event_contract().schema()


def contract_from_json_schema(document: Mapping) -> Contract:
    """Contract of a JSON Schema with flat properties."""
    fields = []
    for name, spec in document["properties"].items():
        kinds = [spec["type"]] if isinstance(spec["type"], str) else list(spec["type"])
        fields.append(
            Field(
                name=name,
                kind=next(k for k in kinds if k != "null"),
                nullable="null" in kinds,
                enum=tuple(v for v in spec.get("enum", ()) if v is not None),
                pattern=spec.get("pattern"),
                minimum=spec.get("minimum"),
                maximum=spec.get("maximum"),
                const=spec.get("const"),
                date_time=spec.get("format") == "date-time",
            )
        )
    return Contract(
        fields=tuple(fields),
        required=frozenset(document.get("required", ())),
        closed=document.get("additionalProperties", True) is False,
        partitioning=tuple(document.get("x-partitioning", {}).get("parquet", ())),
    )


def read_contract(spark: SparkSession, path: str) -> Contract:
    """Contract from a JSON Schema file on any file system Spark reads; the file is one small record."""
    return contract_from_json_schema(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def level_name_contract(contract: Contract, names: Mapping[str, str], column: str = "congestion_level") -> Contract:
    """The contract with renamed enum values of one field."""
    renamed = [
        Field(**{**f.__dict__, "enum": tuple(names.get(v, v) for v in f.enum)}) if f.name == column else f
        for f in contract.fields
    ]
    return replace(contract, fields=tuple(renamed))
