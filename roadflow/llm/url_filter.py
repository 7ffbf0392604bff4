"""Verdicts on page addresses: prefix rules first, then a weighted vocabulary.

An address is split into host and path. A rule (host, path, verdict) fits its host and all subdomains when the path
starts with the rule's; of those that fit, the longest decides. Addresses without a rule are judged by their terms: an
Aho-Corasick automaton finds every term in one pass, a hit counts when no letter or digit touches it, and the address
is blocked by one strict term or by ``soft_needed`` different soft terms.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules and the vocabulary.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
STRICT = ["adult", "casino", "escort", "hentai", "malware", "nude", "phishing", "porn", "viagra", "xxx"]
SOFT = [
    "ads", "bet", "bets", "bonus", "cheap", "click", "deal", "deals", "download", "farm", "free", "gambling", "loan",
    "lottery", "pill", "pills", "poker", "prize", "spam", "track", "tracker", "win", "winner",
]
SOFT_NEEDED = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def deciding_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = _fits(host, path, rule_host, rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def term_counter(strict=STRICT, soft=SOFT):
    """Column function: distinct strict and soft terms of an address, with boundary checks on both sides."""
    weights = {t: 1 for t in soft} | {t: 0 for t in strict}

    @F.pandas_udf("strict array<string>, soft array<string>")
    def found(urls: pd.Series) -> pd.DataFrame:
        machine = ahocorasick.Automaton()
        for term, kind in weights.items():
            machine.add_word(term, (term, kind))
        machine.make_automaton()
        rows = []
        for url in urls:
            text, hits = (url or "").lower(), (set(), set())
            for end, (term, kind) in machine.iter(text):
                start = end - len(term) + 1
                left = start and text[start - 1].isascii() and text[start - 1].isalnum()
                right = end + 1 < len(text) and text[end + 1].isascii() and text[end + 1].isalnum()
                if not left and not right:
                    hits[kind].add(term)
            rows.append((sorted(hits[0]), sorted(hits[1])))
        return pd.DataFrame(rows, columns=["strict", "soft"])

    return found


def judged(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the terms found.

    A null or malformed address has an empty host and path, fits no rule and is judged by its terms (null: none, so
    allowed). Repeated rows are judged each; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, says = deciding_rule(F.col("host"), F.col("path"), rules)
    terms = rows.select("page_id", "host", "path", term_counter(strict, soft)("url").alias("terms"))
    blocked = (F.size("terms.strict") > 0) | (F.size("terms.soft") >= soft_needed)
    return terms.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(says, F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("terms.strict").alias("strict_terms"),
        F.col("terms.soft").alias("soft_terms"),
    )
