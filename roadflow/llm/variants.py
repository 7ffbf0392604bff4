"""Spelling variants: words that differ by one inserted, deleted or replaced character, by a sorted permuterm table.

Every word is marked with a terminator and turned: the rotation at place i reads from there to the end, over the terminator,
round to the start. Two words that differ in the character before place i share the rotation at i but for its last
character, and a word that lacks that character has exactly the shorter rotation. So in a table of all rotations, whole
ones and ones without their last character, sorted by what they read, the words that differ in one place stand
together. A group has one whole rotation at most and one shortened rotation for each last character, so its size is
bounded by the alphabet. A scan counts each member's neighbours and picks its best one; pairs are never listed.

Two words meet in one group only: a replaced character has one place, and of a run of equal characters, any of which may be
left out to the same effect, only the first counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.session import staged

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
TIMES = 2
MARK = "$"  # not a character of any word


def occurrences(docs: DataFrame, drop_every: int = DROP_EVERY) -> DataFrame:
    """word and n: runs of letters of all texts, A-Z lower-cased, with the planted misspellings, and how often they occur.

    Where ``drop_every`` divides the checksum h of a run's document and text, the run loses the character at h modulo its length.
    """
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc"), F.explode(found).alias("run"))
    runs = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    # Once for each run of a document; all its occurrences change alike.
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """The permuterm rows of ``words`` (word, n): reads, and last: null for a whole rotation, else the character it lacks.

    ``single`` is false where leaving out the character before gives the same shorter word.
    """
    size = F.char_length("word")

    def tail(place: Column) -> Column:
        return F.substring(F.col("word"), place + 1, size)

    def head(place: Column) -> Column:
        return F.substring(F.col("word"), F.lit(1), place)

    def char(place: Column) -> Column:
        return F.substring(F.col("word"), place + 1, F.lit(1))

    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(F.concat(tail(i), F.lit(MARK), head(i)).alias("reads"), F.lit(None).cast("string").alias("last"), F.lit(True).alias("single")),
    )
    short = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            F.concat(tail(i + 1), F.lit(MARK), head(i)).alias("reads"),
            char(i).alias("last"),
            ((i == 0) | (char(i) != char(i - 1))).alias("single"),
        ),
    )
    return words.select("word", "n", F.explode(F.concat(whole, short)).alias("row")).select("word", "n", "row.*")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near and best (its near word of largest n, the smallest of those): words that have a near word.

    The rotations are sorted in ranges over the cluster and scanned group by group.
    """
    index = rotations(words).repartitionByRange("reads").sortWithinPartitions("reads", "last")
    group = Window.partitionBy("reads")
    ordered = group.orderBy("last")
    before, after = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(1, Window.unboundedFollowing)
    is_whole = F.col("last").isNull()
    own = F.struct((-F.col("n")).alias("less"), "word")  # the smallest is the best
    shortened, longer = F.when(~is_whole, own), F.when(~is_whole & F.col("single"), own)
    scanned = index.select(
        "word",
        is_whole.alias("is_whole"),
        "single",
        F.count(shortened).over(group).alias("replaced"),
        F.count(longer).over(group).alias("longer"),
        F.count(F.when(is_whole, 1)).over(group).alias("whole"),
        F.min(longer).over(group).alias("best_longer"),
        F.min(F.when(is_whole, own)).over(group).alias("best_whole"),
        F.least(F.min(shortened).over(before), F.min(shortened).over(after)).alias("best_replaced"),
    )
    joins_whole = F.col("single") & (F.col("whole") > 0)
    near = F.when(F.col("is_whole"), F.col("longer")).otherwise(F.col("replaced") - 1 + joins_whole.cast("long"))
    best = F.when(F.col("is_whole"), F.col("best_longer")).otherwise(
        F.least("best_replaced", F.when(joins_whole, F.col("best_whole")))
    )
    return (
        scanned.select("word", near.alias("near"), best.alias("best"))
        .filter("near > 0")
        .groupBy("word")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def variants(docs: DataFrame, drop_every: int = DROP_EVERY) -> DataFrame:
    """One row per word of at least five characters and three occurrences: word, n, n_near, form, form_n and root.

    ``form`` is the near word of largest n (of ties the smallest) if it occurs at least twice as often, else null; ``root`` is
    the last word that forms lead to. Null texts have no words, a null doc_id counts as empty, repeated rows count
    again, an empty table gives no rows; other columns are not read.
    """
    words = occurrences(docs, drop_every).filter(f"char_length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}")
    words = staged(words, "words")
    found = words.join(neighbours(words), "word", "left")
    common = -F.col("best.less") >= TIMES * F.col("n")
    found = staged(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.word")).alias("form"),
            F.when(common, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return found.join(roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(found: DataFrame) -> DataFrame:
    """word and root of the words with a form.

    Every step at least doubles n, so a chain has at most 62 forms; each round doubles the way that was followed.
    """
    at = staged(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = staged(at.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"), "roots")
        at = moved.drop("beyond")
        if moved.filter("beyond IS NOT NULL").isEmpty():
            return at
