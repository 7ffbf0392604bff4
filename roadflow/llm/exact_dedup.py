"""Exact duplicates by a heavy-hitter split, in DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty. A frequent-items sketch of the
Misra-Gries family (at most ``tracked`` counters a sketch, merged in two levels) finds the digests that may be
frequent. Their exact counts and winners, at most ``tracked`` rows, are broadcast, and every row of such a group is
labelled or removed where it is read. All other digests are shuffled: what the sketch did not report has less than
3.5 / ``tracked`` of all rows, so no group of them is large beside the input.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.session import staged

TRACKED = 4096
SKETCH_GROUPS = 64


def text_digest(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(folded, 256)


def heavy_winners(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Frequent groups of a table (doc_id, digest, row): digest, group_size and the winning (doc_id, row)."""
    sketches = rows.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("sketch")
    )
    # By a key, though there is one only: without keys, a task that has no sketches would add one without a type.
    merged = sketches.groupBy(F.pmod("part", F.lit(1)).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    )
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("top"))
    # The sketch also lists digests that it saw once; counting twice leaves those that repeat.
    candidates = found.filter("top.count > 1").select(F.col("top.item").alias("digest"))
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("winner"))
        .filter("group_size > 1")
    )


def _narrow(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    return staged(rows, "digests")


def exact_groups(docs: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256.

    The row with the largest doc_id of equal texts stays; a null doc_id is the smallest. Of repeated rows (same
    doc_id, same text) exactly one has ``kept``. An empty table gives no rows; other columns are not read.
    """
    rows = _narrow(docs)
    winners = staged(heavy_winners(rows, tracked), "winners")  # at most ``tracked`` rows
    split = rows.join(F.broadcast(winners), "digest", "left")
    heavy = split.filter("group_size is not null")
    group = Window.partitionBy("digest")
    light = (
        split.filter("group_size is null")
        .withColumn("group_size", F.count(F.lit(1)).over(group))
        .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``docs`` with one row of every group of equal texts, that with the largest doc_id; all columns stay.

    Copies of frequent texts are removed where they are read, the rest in one shuffle. Any extra columns are allowed,
    under any name; of repeated rows one stays.
    """
    winners = staged(heavy_winners(_narrow(docs), tracked), "winners").select("digest", F.col("winner.doc_id").alias("keep"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), text_digest(F.col("text")).alias("digest"))
    left = (
        rows.join(F.broadcast(winners.withColumn("heavy", F.lit(True))), "digest", "left")
        .filter(F.col("heavy").isNull() | F.col("doc.doc_id").eqNullSafe(F.col("keep")))
        .select("doc", "digest")
    )
    order = Window.partitionBy("digest").orderBy(F.col("doc.doc_id").desc_nulls_last())
    return left.withColumn("place", F.row_number().over(order)).filter("place = 1").select("doc.*")
