"""Both operators on repeated windows against all windows, on texts with few different units."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import EDGES
from roadflow.llm import repeats, substring_dedup, suffix_dedup


def brute_words(rows, size):
    cut = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    big = max((i for i, _ in cut if i is not None), default=0)
    order = [big + 1 if i is None else i for i, _ in cut]
    least = {}
    for rank, (_, w) in zip(order, cut):
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            least[k] = min(least.get(k, rank), rank)
    out = []
    for rank, (i, w) in zip(order, cut):
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if least[tuple(w[s : s + size])] < rank:
                gone[s : s + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(rows, size):
    cut = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[s : s + size] for _, t in cut for s in range(len(t) - size + 1))
    out = []
    for i, t in cut:
        gone = bytearray(len(t))
        for s in range(len(t) - size + 1):
            if seen[t[s : s + size]] > 1:
                gone[s : s + size] = b"\1" * size
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = random.Random(seed)
    words = ["a", "bb", "ccc", "é", "dd"]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 30))) for _ in range(4)]
    rows = []
    for k in range(40):
        parts = [" ".join(f"u{k}_{i}_{rng.randint(0, 3)}" for i in range(rng.randint(0, 12)))]
        parts += [rng.choice(shared) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        rows.append((rng.randint(0, 10**6) * 2**20 + k, rng.choice([" ", "\n", "  "]).join(parts)))
    return rows + [(10**15, rows[0][1]), (10**16, "ab" * 60), (10**16 + 1, "z" * 90)]


@pytest.mark.parametrize("seed", range(3))
def test_words(docs_of, seed):
    rows = passages(seed)
    got = substring_dedup.without_repeats(docs_of(rows), window=6, prefix=2).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_words(rows, 6)


@pytest.mark.parametrize("seed", range(3))
def test_bytes(docs_of, seed):
    rows = passages(seed)
    got = suffix_dedup.without_repeats(docs_of(rows), window=24, prefix=7).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)
    assert found == brute_bytes(rows, 24)


def test_production_sizes_on_whole_documents(small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got = substring_dedup.without_repeats(small).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_words(rows, 13)
    got = suffix_dedup.without_repeats(small).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)
    assert found == brute_bytes(rows, 200)


def test_edges_and_repeated_rows(docs_of):
    again = (77, " ".join(f"w{i}" for i in range(60)))
    rows = EDGES + [again, again, (78, again[1])]
    words = substring_dedup.without_repeats(docs_of(rows)).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in words), key=repr)
    assert found == brute_words(rows, 13)
    data = suffix_dedup.without_repeats(docs_of(rows)).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in data), key=repr)
    assert found == brute_bytes([(i, t) for i, t in rows], 200)
    assert substring_dedup.without_repeats(docs_of([])).count() == 0
    assert suffix_dedup.without_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("kind, rule", [("words", "earlier"), ("bytes", "anywhere")])
def test_one_phrase_in_all_documents_is_dealt_over_the_buckets(spark, docs_of, monkeypatch, kind, rule):
    phrase = "the one very common phrase of all that we know here ok"
    rows = [(k, " ".join(f"l{k}x{i}" for i in range(9)) + f" {phrase} " + " ".join(f"r{k}x{i}" for i in range(9))) for k in range(400)]
    rows += [(1000 + k, t) for k, (_, t) in enumerate(rows[:9])]
    units = repeats.Units(kind, *((13, 5) if kind == "words" else (60, 20)), rule)
    docs = repeats.keyed(docs_of(rows))
    many = repeats.crowded(docs, units)
    assert 0 < len(many) <= 8 * repeats._buckets(docs)
    dealt = []
    monkeypatch.setattr(repeats, "WIDE_WINDOWS", 0)
    exchange = repeats._exchange

    def kept(entries, *rest):
        dealt.append([(r.bucket, np.frombuffer(r.a, np.uint64)) for r in entries.filter("kind != 1").collect()])
        return exchange(entries, *rest)

    monkeypatch.setattr(repeats, "_exchange", kept)
    repeats.repeated_spans(docs_of(rows), units).count()
    for step in dealt:  # anchors, then windows
        hashes, n = np.unique(np.concatenate([a for _, a in step]), return_counts=True)
        most = hashes[n.argmax()]
        assert n.max() > 300 and len({bucket for bucket, a in step if most in a}) > 2


@pytest.mark.parametrize("seed", range(2))
def test_results_do_not_depend_on_how_entries_are_dealt(docs_of, monkeypatch, seed):
    monkeypatch.setattr(repeats, "WIDE_WINDOWS", 0)
    rows = passages(seed)
    got = substring_dedup.without_repeats(docs_of(rows), window=6, prefix=2).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_words(rows, 6)
    got = suffix_dedup.without_repeats(docs_of(rows), window=24, prefix=7).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)
    assert found == brute_bytes(rows, 24)


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup])
def test_ids_of_text(spark, small, operator):
    named = small.selectExpr("concat('u-', lpad(doc_id, 9, '0')) AS doc_id", "text").unionByName(
        spark.createDataFrame([(None, "x " * 300), ("u-0", None)], "doc_id string, text string")
    )
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in operator.without_repeats(named).collect()}
    for r in operator.without_repeats(small).collect():
        assert got[f"u-{r.doc_id:09d}"] == (r.n_removed, r.kept_sha256)
    assert len(got) == small.count() + 2


def test_buckets_follow_the_entries_and_not_the_shuffle_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        counts = []
        for width in (8, 64, 211):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            counts.append([repeats._bucket_count(spark.range(1), n) for n in (0, 1000, 206_147, 2_000_000)])
            assert repeats._bucket_count(spark.range(1), 10**12) == 10**12 // repeats.MANY + 1
        assert counts[0] == counts[1] == counts[2] == [8, 8, 8, 31]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
