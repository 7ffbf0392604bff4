"""Queries of the operators that SQL can express in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadflow.llm import exact_dedup, url_filter
from roadflow.llm.registry import query, table

OP10_SQL = f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _term_sql(term: str) -> str:
    return f"CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') THEN 1 ELSE 0 END"


def _rule_sql(rules, value) -> str:
    arms = " ".join(
        f"WHEN ('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}') THEN '{value(host, path, says)}'"
        for host, path, says in sorted(rules, key=lambda r: -len(r[0]) - len(r[1]))
    )
    return f"CASE {arms} END"


OP7_SQL = f"""
WITH a AS (
  SELECT page_id, lower(coalesce(url, '')) AS low,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (
  SELECT page_id, low,
    translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM a),
c AS (
  SELECT page_id, host, path, {_rule_sql(url_filter.RULES, lambda h, p, v: h + p)} AS rule,
    {_rule_sql(url_filter.RULES, lambda h, p, v: v)} AS says,
    {' + '.join(map(_term_sql, url_filter.STRICT))} AS strict_hits,
    {' + '.join(map(_term_sql, url_filter.SOFT))} AS soft_hits FROM b)
SELECT page_id, host, path, rule,
  coalesce(says, CASE WHEN strict_hits >= 1 OR soft_hits >= {url_filter.SOFT_NEEDED} THEN 'block' ELSE 'allow' END)
    AS verdict, strict_hits::INT AS strict_hits, soft_hits::INT AS soft_hits
FROM c"""


@query("op7_url_filter", OP7_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judged(table(spark, sf_dir, "pages"))
    return found.selectExpr(
        "page_id", "host", "path", "rule", "verdict", "size(strict_terms) AS strict_hits", "size(soft_terms) AS soft_hits"
    )
