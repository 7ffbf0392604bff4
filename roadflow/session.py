"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_PARTITION_MB = 256


def shuffle_width(gigabytes: float, cores: int = 8) -> int:
    """Shuffle partitions of about 256 MB for the largest shuffle of a job, and at least one per core.

    Adaptive execution merges partitions that turn out small, so a high number costs little; a low one makes
    every task spill. Stateful streams keep the number they started with.
    """
    return max(cores, math.ceil(gigabytes * 1024 / SHUFFLE_PARTITION_MB))


def session(
    app: str = "roadflow", master: str | None = None, shuffle_gb: float | None = None, **conf: str
) -> SparkSession:
    """Session with adaptive execution on; anything in ``conf`` (dots as ``__``) wins.

    ``shuffle_gb`` sizes the shuffles for a job whose largest one moves that much.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    if shuffle_gb is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_width(shuffle_gb))
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block; afterwards it is what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a missing setting is an error,
    because a table on one machine's disk would be lost with that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="roadflow-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_staged_paths: list[str] = []


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables that ``staged`` has written so far; returns how many.

    For a caller that is done with everything that was built on them: what a build returns still reads them.
    """
    done = 0
    while _staged_paths:
        done += delete_path(spark, _staged_paths.pop())
    return done


def delete_path(spark: SparkSession, name: str) -> bool:
    """Delete a folder in any store that Spark can reach; whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back; ``drop_staged`` removes it again.

    Later readers share the work and survive lost executors, and Spark knows the size of the written
    table: a join broadcasts it when that size is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles it otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _staged_paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
