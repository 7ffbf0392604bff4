from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import EDGES
from roadflow.llm import near_dedup as nd
from roadflow.llm.arrays import mix


def bag(text, size=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    words = [w for w in words if w]
    if not words:
        return Counter()
    if len(words) < size:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def jaccard(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


def brute(rows):
    """Smallest id of each document's component of equal or similar texts."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "").lower() == (rows[j][1] or "").lower()
            if same or jaccard(bags[i], bags[j]) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for k, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(doc_id)
    return {rows[k][0]: min(i for i in groups[root(k)]) for k in range(len(rows))}


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(5)
    one = {i: int(rng.integers(1, 12)) for i in range(60)}
    two = {i: max(1, v + int(rng.integers(-4, 5))) for i, v in one.items() if rng.random() < 0.8} | {90: 7, 91: 1}
    true = jaccard(Counter(one), Counter(two))
    seen = []
    for salt in range(40):
        tables = []
        for weights in (one, two):
            keys = np.array(sorted(weights), np.uint64)
            hashes = mix(keys + np.uint64(salt * 1000))
            counts = np.array([weights[int(k)] for k in keys])
            tables.append(nd.bag_minhash(np.zeros(len(keys), np.int64), hashes, counts, 1, 256)[0])
        seen.append((tables[0] == tables[1]).mean())
    assert abs(np.mean(seen) - true) < 4 * np.sqrt(true * (1 - true) / (40 * 256))


def test_signatures_do_not_depend_on_the_batch():
    hashes = mix(np.arange(200, dtype=np.uint64))
    counts = np.arange(200) % 9 + 1
    alone = nd.bag_minhash(np.zeros(200, np.int64), hashes, counts, 1, 64)
    text = np.repeat([0, 2], 200)
    both = nd.bag_minhash(text, np.tile(hashes, 2), np.tile(counts, 2), 3, 64)
    assert (both[0] == alone[0]).all() and (both[2] == alone[0]).all() and (both[1] == nd._NEVER).all()


def test_similarities_are_exact():
    texts = ["a b c d e f g h", "A b c d e f g h", "a a a a a a a a a", "a a a a a a a", "", "x", "x y", "a b c d e f g z"]
    left = [a for a in texts for _ in texts]
    right = [b for _ in texts for b in texts]
    got = nd.similarities(pa.array(left), pa.array(right))
    assert np.allclose(got, [jaccard(bag(a), bag(b)) for a, b in zip(left, right)])


def test_classes_agree_with_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in nd.classes(small).collect()}
    assert {k: r.class_id for k, r in got.items()} == brute(rows)
    assert sum(r.kept for r in got.values()) == len({r.class_id for r in got.values()})
    kept = nd.without_near_copies(small)
    assert kept.columns == small.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in got.values()})


def test_a_large_group_of_near_copies_is_one_class(docs_of):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 120):
        own = list(base)
        for at in rng.choice(150, 2, replace=False):
            own[at] = f"new{k}_{at}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(f"other{k}_{i}" for i in range(80))) for k in range(20)]
    got = {r.doc_id: r.class_id for r in nd.classes(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_edges(docs_of):
    rows = EDGES + [(4, "one"), (8, "ONE"), (9, None)]
    got = nd.classes(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.class_id for r in got}
    assert by[8] == by[4] == 4 and by[1] == by[2] == by[9] == 1 and by[3] == 3 and by[5] == 5
    assert sum(r.kept for r in got) == 6
    assert nd.without_near_copies(docs_of(rows)).count() == 6
    assert nd.classes(docs_of([])).count() == 0


def test_repeated_rows_under_one_id_are_one_node(docs_of):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text)] * 300 + [(None, text.upper())] * 5 + [(8, text + " tail")] + [(9, " ".join(f"v{i}" for i in range(40)))]
    got = nd.classes(docs_of(rows)).collect()
    assert len(got) == 307 and {(r.doc_id, r.class_id) for r in got} == {(7, 7), (None, 7), (8, 7), (9, 9)}
    assert sum(r.kept for r in got) == 2
    assert nd.without_near_copies(docs_of(rows)).count() == 2
