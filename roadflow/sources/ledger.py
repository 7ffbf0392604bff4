"""Loads with a ledger: a table that says of every file of a folder whether it was loaded, and what was lost of it.

A load takes the files that the ledger does not know, writes their rows to a folder of its own under its number, and then
commits by appending its files to the ledger. A load that failed before has left no entry: the next one has its number
and replaces its folder, so every row is stored once. Readers see committed loads only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.session import delete_path
from roadflow.sources.tables import by_name, cast_failures

LEDGER = (
    T.StructType()
    .add("file", "string")
    .add("modified", "timestamp")
    .add("length", "long")
    .add("load_id", "long")
    .add("state", "string")
    .add("rows", "long")
    .add("lost", T.MapType(T.StringType(), T.LongType()))
)
COMPACTIONS = T.StructType().add("load_id", "long").add("last", "long")
FAILURES = (PySparkException, Py4JJavaError)  # of a write, Spark may raise either
KEY = ["file", "modified", "length"]
LOADED, EMPTY, PARTLY, UNREADABLE = "loaded", "empty", "partly read", "unreadable"


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """file, modified, length, load_id, state, rows and lost (values by field that did not fit), one row a file."""
    return table_or_empty(spark, path, LEDGER)


def unseen(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Files of a folder that the ledger at ``path`` does not know in their present form; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    listed = listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), "length")
    return listed.join(ledger(spark, path), KEY, "left_anti")


def _rows(spark: SparkSession, files: list[str], schema: T.StructType, kind: str, forgiving: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("ignoreCorruptFiles", forgiving)
    return reader.format(kind).load(files)


def _damaged(error: Exception) -> bool:
    said = str(error)
    return any(sign in said for sign in ("FAILED_READ_FILE", "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "ParquetDecodingException"))


def _rows_read(schema: T.StructType) -> Column:
    """Number of rows, for which every column has to be read; a plain count would read none."""
    mixed = F.xxhash64(*schema.names)
    return F.count(F.when(mixed < 0, 1)) + F.count(F.when(mixed >= 0, 1))


def broken_files(spark: SparkSession, files: list[str], schema: T.StructType, kind: str = "parquet") -> list[str]:
    """Of ``files`` those that cannot be read to their end; halves of a list that reads well are not looked into."""
    rows = _rows(spark, files, schema, kind, False)
    try:
        rows.agg(_rows_read(schema)).collect()  # one value
        return []
    except FAILURES as error:
        if not _damaged(error):
            raise
    if len(files) == 1:
        return files
    half = len(files) // 2
    return broken_files(spark, files[:half], schema, kind) + broken_files(spark, files[half:], schema, kind)


def load(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    wanted: T.StructType,
    path: str,
    columns: Mapping[str, Column] | None = None,
    partition_by: Iterable[str] = (),
    renames: Mapping[str, str] | None = None,
    kind: str = "parquet",
    max_files: int | None = None,
) -> int | None:
    """Append the new files of ``source`` to ``target``, matched by column name; the load's number, or None if all are known.

    ``columns`` are derived from the target's columns and stored too. Files that break are loaded as far as they can be
    read; the ledger says so, and how many values of each field did not fit. ``max_files`` takes the oldest files only.
    """
    new = unseen(spark, source, path)
    if max_files:
        new = new.orderBy("modified", "file").limit(max_files)
    new = spark.createDataFrame(new.collect(), new.schema)  # names of the new files, fixed for this load
    files = [r.file for r in new.select("file").collect()]
    if not files:
        return None
    number = (ledger(spark, path).agg(F.max("load_id")).first()[0] or 0) + 1
    parts = list(partition_by)

    def store(forgiving: bool) -> None:
        rows = by_name(_rows(spark, files, schema, kind, forgiving), wanted, renames).withColumns(dict(columns or {}))
        rows = rows.hint("rebalance", *parts) if parts else rows
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(f"{target}/load_id={number}")

    broken: list[str] = []
    try:
        store(False)
    except FAILURES as error:
        if not _damaged(error):
            raise
        broken = broken_files(spark, files, schema, kind)
        store(True)
    entries = _entries(spark, new, files, broken, schema, wanted, renames, kind)
    entries.withColumn("load_id", F.lit(number).cast("long")).select(*LEDGER.names).write.mode("append").parquet(path)
    return number


def _entries(spark, new, files, broken, schema, wanted, renames, kind) -> DataFrame:
    """A row of the ledger for each new file, but for the load's number; sound files are read in converted columns only."""
    name = F.col("_metadata.file_path").alias("file")

    def counted(found: DataFrame, rows: Column) -> DataFrame:
        lost = cast_failures(found, wanted, renames)
        grouped = found.groupBy("file").agg(rows.alias("rows"), *lost)
        fields = [c for c in grouped.columns if c not in ("file", "rows")]
        pairs = [F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in fields]
        kept = F.filter(F.array(*pairs), lambda p: p["value"] > 0) if pairs else F.array().cast("array<struct<key:string,value:bigint>>")
        return grouped.select("file", "rows", F.map_from_entries(kept).alias("lost"))

    sound = [f for f in files if f not in set(broken)]
    tables = []
    if sound:
        found = _rows(spark, sound, schema, kind, False).select("*", name)
        tables.append(counted(found, F.count(F.lit(1))))
    if broken:
        found = _rows(spark, broken, schema, kind, True).select("*", name)
        # As for the load, all columns are read: how far a broken file gives rows depends on what is read of it.
        tables.append(counted(found, _rows_read(schema)))
    seen = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])

    def plain(path: Column) -> Column:
        return F.regexp_replace(path, "^file:/+", "file:/")

    seen = seen.select(plain(F.col("file")).alias("plain"), "rows", "lost")
    bad = F.col("file").isin(broken) if broken else F.lit(False)
    some = F.coalesce("rows", F.lit(0)) > 0
    state = F.when(bad & some, PARTLY).when(bad, UNREADABLE).when(some, LOADED).otherwise(EMPTY)
    none = F.create_map().cast("map<string,bigint>")
    return new.withColumn("plain", plain(F.col("file"))).join(seen, "plain", "left").select(
        *KEY, state.alias("state"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("lost", none).alias("lost")
    )


def errors(spark: SparkSession, path: str) -> DataFrame:
    """What loads have lost, from the ledger alone: rows (load_id, file, field, n, reason); field and n are null for files
    that broke or gave no row."""
    known = ledger(spark, path)
    lost = known.select("load_id", "file", F.explode("lost").alias("field", "n"), F.lit("value does not fit").alias("reason"))
    none = [F.lit(None).cast("string").alias("field"), F.lit(None).cast("long").alias("n")]
    bad = known.filter(F.col("state") != LOADED).select("load_id", "file", *none, F.col("state").alias("reason"))
    return lost.unionByName(bad)


def loaded(spark: SparkSession, target: str, schema: T.StructType, path: str, compactions: str) -> DataFrame:
    """The rows of committed loads; ``schema`` names the target's columns, derived and partition columns included."""
    latest = table_or_empty(spark, compactions, COMPACTIONS).agg(F.min("load_id").alias("id"), F.max("last").alias("last")).first()
    last = ledger(spark, path).agg(F.max("load_id")).first()[0] or 0
    known = F.col("load_id").between((latest.last or 0) + 1, last)
    if latest.id is not None:
        known |= F.col("load_id") == latest.id
    whole = T.StructType([*schema.fields, T.StructField("load_id", T.LongType())])
    return table_or_empty(spark, target, whole).filter(known)


def compact(
    spark: SparkSession, target: str, schema: T.StructType, path: str, compactions: str, last: int, partition_by: Iterable[str] = ()
) -> int | None:
    """Rewrite the loads up to ``last`` as one folder with few files; its number (below zero), or None if there is one load only.

    The new folder counts from the moment its entry is written, and the old ones no longer do; a run that ends before
    leaves a folder that nobody reads and that the next run replaces, one that ends after leaves only what to delete.
    """
    rows = loaded(spark, target, schema, path, compactions).filter(F.col("load_id") <= last)
    old = sorted(r.load_id for r in rows.select("load_id").distinct().collect())  # one value a load
    if len(old) < 2:
        return None
    number = min(0, old[0]) - 1
    parts = list(partition_by)
    kept = rows.drop("load_id")
    kept = kept.hint("rebalance", *parts) if parts else kept
    kept.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(f"{target}/load_id={number}")
    spark.createDataFrame([(number, last)], COMPACTIONS).coalesce(1).write.mode("append").parquet(compactions)
    for load_id in old:
        delete_path(spark, f"{target}/load_id={load_id}")
    return number
