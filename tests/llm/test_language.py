import pyarrow as pa
import pytest
from conftest_llm import EDGES
from pyspark.sql import functions as F
from roadflow.llm import language
from roadflow.llm.arrays import text_bytes


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(labelled):
    found = language.identified(labelled).join(labelled.select("doc_id", "lang"), "doc_id")
    rows = found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()
    assert {r.held_out for r in rows} == {True, False} and all(r.right > 0.98 for r in rows)
    assert found.filter("score < 0 or score > 1").count() == 0


def test_mixed_texts_have_their_languages(labelled):
    model = language.fit(labelled.select("lang", "text"))
    texts = {k: labelled.filter(f"lang = '{k}'").orderBy(F.desc("n_chars")).first().text[:2000] for k in ("en", "de")}
    mixed = texts["en"][:1500] + " " + texts["de"][:700]
    shares, _ = language.mixtures(*text_bytes(pa.array([mixed, texts["de"], ""])), model)
    en, de = model.languages.index("en"), model.languages.index("de")
    assert shares[0, en] > shares[0, de] > 0.2 and shares[0].sum() == pytest.approx(1)
    assert shares[1, de] > 0.97 and shares[2].sum() == 0


def test_edges(docs_of):
    rows = [(i, t, "en") for i, t in EDGES] + [(20, "123 ... 456", "de"), (21, "über den Wolken", "de"), (22, "ÜBER", None)]
    got = {r.doc_id: r for r in language.identified(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 20))
    assert got[21].lang_pred == "de" and got[4].lang_pred == "en"
    kept = language.with_language(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 6, 21}
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3, 20}


def test_without_labels_or_rows(docs_of):
    got = language.identified(docs_of([(1, "some words"), (1, "some words")])).collect()
    assert [r.lang_pred for r in got] == ["und", "und"]
    assert language.with_language(docs_of([(1, "some words"), (2, "12")])).count() == 1
    assert language.identified(docs_of([])).count() == 0
    assert language.with_language(docs_of([])).count() == 0


def test_texts_that_no_learned_language_fits_are_rejected(spark, labelled):
    clean = labelled.select("doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    others = [
        "Zażółć gęślą jaźń, niedaleko rzeki stoi dom i wszyscy śpią spokojnie przez całą noc",
        "Tämä on suomenkielinen teksti, jossa kerrotaan pitkästä talvesta ja kylmästä järvestä",
        "это русский текст о погоде и о людях",
        "日本語の文章です。今日は天気がいい。",
        "QmFzZTY0IGR1bXAgd2l0aCBsZXR0ZXJzIGFuZCBkaWdpdHM6IGFHVnNiRzg9IHhrODl6 " * 4,
    ]
    planted = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(others)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language.with_language(clean.unionByName(planted)).select("doc_id").collect()}
    letters = {r.doc_id for r in clean.filter(language.has_letter(F.col("text"))).collect()}
    assert not any(k < 0 for k in kept) and len(kept & letters) >= 0.99 * len(letters)
