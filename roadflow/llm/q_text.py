"""Queries of the operators that judge each text by itself, with a model made from all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.llm import decontaminate, language, licences, personal_data
from roadflow.llm.registry import query, table


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query("op5_licence_scan")
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.scanned(table(spark, sf_dir, "documents"))
    said = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    more = F.transform("found", lambda s: F.concat_ws(":", F.lit(personal_data.FOUND), s["start"], s["stop"]))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, personal_data.KINDS),
        F.sha2(F.array_join(said, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(said, more), ",").alias("spans"),
    )
