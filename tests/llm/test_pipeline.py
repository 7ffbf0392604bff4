import check
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from roadflow.llm.queries import CHECKS, QUERIES
from roadflow.session import staged
from test_near import brute as near_classes

SF = "/root/testdata/sf0.001"


def test_stages_agree_with_brute_force(spark, small):
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in small.select("doc_id", "text").collect()}
    docs, outputs = small, []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "stage")
        outputs.append(docs)
        if stage is not corpus_pipeline.packing_stage:
            assert docs.columns == small.columns
    language, exact, near, clean, packed = ({r.doc_id for r in o.select("doc_id").collect()} for o in outputs)
    assert language == {k for k, t in rows.items() if any(c.isalpha() for c in t)}
    last = {}
    for k in sorted(language):
        last["".join(c.lower() if "A" <= c <= "Z" else c for c in rows[k])] = k
    assert exact == set(last.values())
    assert near == set(near_classes([(k, rows[k]) for k in sorted(exact)]).values())
    assert clean == {k for k in near if not any(b in rows[k] for b in benchmark)} == packed
    assert outputs[-1].groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_registered():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 11)]
    found = entry.queries()
    assert [sum(q.startswith(n) for q in found) for n in names] == [1] * 10 and found["pipeline"] is corpus_pipeline.run
    assert set(QUERIES) <= set(found) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(check, "queries", lambda: QUERIES)
    monkeypatch.setattr(check, "oracle_sql", lambda: CHECKS)
    assert check.compare(spark, check.connect(SF), SF, name) == ""
