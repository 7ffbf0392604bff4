"""Set operations between tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(tables: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """All rows of the named tables, columns matched by name, each row with the name of its table."""
    named = [df.withColumn(source, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def only_in_first(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of the first table that the second does not have.

    Both sides are reduced where they are read and meet in one grouping, so a value that fills a large part of either
    table arrives once from each task.
    """
    left = a.select(*columns).withColumn("_second", F.lit(0))
    right = b.select(*columns).withColumn("_second", F.lit(1))
    return left.unionByName(right).groupBy(*columns).agg(F.max("_second").alias("_second")).filter("_second = 0").drop("_second")


def compare_sets(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """How many distinct values are in one table only, and whether both hold the same set.

    Each side is reduced to its distinct values before they meet, and one grouping tells them apart.
    """
    left = a.select(*columns).distinct().withColumn("_side", F.lit(1))
    right = b.select(*columns).distinct().withColumn("_side", F.lit(2))
    sides = left.unionByName(right).groupBy(*columns).agg(F.sum("_side").alias("_sides"))
    only_first, only_second = F.count(F.when(F.col("_sides") == 1, 1)), F.count(F.when(F.col("_sides") == 2, 1))
    return sides.agg(
        only_first.alias("only_in_first"),
        only_second.alias("only_in_second"),
        ((only_first + only_second) == 0).alias("equal"),
    )
