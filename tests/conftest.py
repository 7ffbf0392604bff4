import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadflow.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    spark = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(folder / "checkpoints"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__driver__memory="4g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame from rows and a schema text; timestamps are given as text and cast."""

    def build(rows, schema):
        from pyspark.sql import functions as F

        parts = [p.strip().split(" ", 1) for p in schema.split(",")]
        loose = ", ".join(f"{n} {'string' if t.startswith('timestamp') or t == 'date' else t}" for n, t in parts)
        df = spark.createDataFrame(rows, loose)
        return df.select(*[F.col(n).cast(t).alias(n) for n, t in parts])

    return build
