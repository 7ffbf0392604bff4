"""Queries on words: spelling variants, fill-in-the-middle forms and the join on shingle sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadflow.llm import fill_middle, ngram_join, variants
from roadflow.llm.registry import query, table


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


_MARKS = [m.decode() for m in fill_middle.SENTINELS]

OP12_SQL = f"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('{fill_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
    ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4 FROM a),
f AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
    CASE WHEN t = '' OR {' OR '.join(f"contains(t, '{m}')" for m in _MARKS)} OR h3 % 100 >= {fill_middle.PLAIN_FROM}
      THEN 'plain' WHEN h4 % 100 < {fill_middle.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:x], '') AS a, array_to_string(u[x + 1:y], '') AS b,
    array_to_string(u[y + 1:n], '') AS c FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(b)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
    ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""


@query("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


@query("op13_ngram_join")
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))
