import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, digest string, row int, node long, key int, bucket int, doc string, place int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns whose names the operators use inside."""

    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, "d", 1, 2, 3, 4, "x", 5) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)

    return build


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


