import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import EDGES
from roadflow.llm import crowds
from roadflow.llm import ngram_join as nj


def shingled(text, size=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows):
    sets = [shingled(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for k, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(doc_id)
    first = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k]), first[root(k)]) for k in range(len(rows))), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, base, times, word="new"):
    own = list(base)
    for at in rng.choice(len(base), times, replace=False):
        own[at] = f"{word}{rng.integers(1 << 40)}"
    return own


@pytest.mark.parametrize("counters", [1 << 20, 64])
def test_components_agree_with_brute_force(small, counters):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert rows_of(nj.joined(small, counters=counters)) == brute(rows)


@pytest.mark.parametrize("boundaries", [[3], [12], [128]])
def test_small_and_large_sets_at_the_threshold(docs_of, monkeypatch, boundaries):
    monkeypatch.setattr(nj, "BOUNDARIES", boundaries)
    rng, rows = np.random.default_rng(3), []
    for k, n in enumerate([1, 3, 5, 6, 7, 8, 9, 10, 12, 13, 14, 16, 18, 20, 22, 24, 30, 45, 60, 100, 170]):
        base = [f"s{k}w{i}" for i in range(n)]
        rows.append((1000 * k, " ".join(base)))
        rows += [(1000 * k + 1 + i, " ".join(base[: n - i])) for i in range(1, max(2, n // 3))]
        rows += [(1000 * k + 100 + i, " ".join(edited(rng, base, min(n, 1 + i % 3)))) for i in range(8)]
        rows += [(1000 * k + 200 + i, " ".join(base + [f"x{j}" for j in range(i)])) for i in range(1, 6)]
    assert rows_of(nj.joined(docs_of(rows))) == brute(rows)


def test_common_passage_and_a_large_group_with_strays(docs_of, monkeypatch):
    monkeypatch.setattr(crowds, "BLOCK", 8)
    rng = np.random.default_rng(7)
    passage, base = [f"p{i}" for i in range(60)], [f"b{i}" for i in range(90)]
    rows = [(k, " ".join(edited(rng, base, 1))) for k in range(60)]
    rows += [(100 + k, " ".join(edited(rng, base, 5))) for k in range(20)]  # about the threshold and below it
    rows += [(200 + k, " ".join([f"d{k}_{i}" for i in range(40)] + passage)) for k in range(60)]
    rows += [(300 + k, " ".join(passage + [f"e{k}_{i}" for i in range(k % 20)])) for k in range(40)]
    rows += [(400 + k, " ".join(base)) for k in range(30)]
    assert rows_of(nj.joined(docs_of(rows), counters=256)) == brute(rows)


def test_edges(docs_of):
    rows = EDGES + [(4, "one"), (8, "ONE"), (9, None), (None, "a b c d e f g"), (11, "a b c d e f g"), (11, "a b c d e f g")]
    assert rows_of(nj.joined(docs_of(rows))) == brute(rows)
    assert nj.joined(docs_of([])).count() == 0
    assert rows_of(nj.joined(docs_of([(1, None), (2, " ")]))) == [(1, 0, 1), (2, 0, 2)]


def test_least_overlap_is_that_of_all_partners():
    for s in range(1, 300):
        partners = [t for t in range(1, 400) if 100 * min(s, t) >= 80 * max(s, t)]
        needed = [next(o for o in range(1, s + t) if 100 * o >= 80 * (s + t - o)) for t in partners]
        assert nj.least_overlap(s) == min(needed)


def test_bitmaps_never_drop_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(4, 400))
        tokens = np.unique(rng.integers(0, 1 << 58, 2 * n, dtype=np.uint64))
        a, b = tokens[:n], tokens[rng.integers(0, n // 8 + 1) : n + int(rng.integers(0, n // 8 + 1))]
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 80 * (len(a) + len(b) - common)
        group = pa.table({
            "home": [True, False], "large": [True, False], "node": [1, 2], "label": [1, 2], "size": pa.array([len(a), len(b)], pa.int32()),
            "bucket": [5, 5], "buckets": pa.array([[5], [5]], pa.list_(pa.int64())), "bitmap": pa.array([nj.parity(a, len(a)), nj.parity(b, len(b))], pa.binary()),
        })
        found = nj._possible(80)(group)
        assert not linked or (found is not None and found.num_rows == 1)


def test_every_pair_of_classes_meets_once_and_rows_grow_in_proportion(spark):
    rng = np.random.default_rng(4)
    rows = [(1, n, 0 if n < 3000 else n) for n in range(3003)] + [(2, n, int(rng.integers(4))) for n in range(700)] + [(3, n, 5) for n in range(400)]
    met = crowds.meetings(spark.createDataFrame(rows, "bucket long, node long, label long"))
    assert met.filter("bucket = 1").count() <= 3003 + 3 * 13 and met.filter("bucket = 3").count() == 0
    pairs = set()
    for (bucket, *_), group in met.toPandas().groupby(["bucket", "block", "chunk"]):
        one, two, fit = crowds.partners(*(group[c].to_numpy() for c in ("home", "large", "node", "label")))
        nodes = group["node"].to_numpy()
        for x, y in zip(*np.nonzero(fit)):
            pair = (bucket, *sorted((int(nodes[one[x]]), int(nodes[two[y]]))))
            assert pair not in pairs
            pairs.add(pair)
    label = {(b, n): k for b, n, k in rows}
    by = {}
    for b, n, _ in rows:
        by.setdefault(b, []).append(n)
    expected = {(b, x, y) for b, ns in by.items() for x in ns for y in ns if x < y and label[b, x] != label[b, y] and (b != 1 or y >= 3000)}
    assert pairs == expected


def test_sets_are_sorted_text_by_text():
    import time

    rng = np.random.default_rng(5)
    text = np.repeat(np.arange(4000), rng.integers(0, 500, 4000))
    tokens = rng.integers(0, 1 << 58, len(text)).astype(np.uint64)
    tokens[1::7] = tokens[::7][: len(tokens[1::7])]

    def by_both():
        order = np.lexsort((tokens, text))
        a, b = tokens[order], text[order]
        new = np.concatenate([[True], (b[1:] != b[:-1]) | (a[1:] != a[:-1])])
        return a[new], np.searchsorted(b[new], np.arange(4001))

    def best(f):
        spent = []
        for _ in range(3):
            start = time.process_time()
            f()
            spent.append(time.process_time() - start)
        return min(spent)

    found, wanted = nj.distinct(tokens, text, 4000), by_both()
    assert np.array_equal(found[0], wanted[0]) and np.array_equal(found[1], wanted[1])
    shuffled = rng.permutation(len(text))
    again = nj.distinct(tokens[shuffled], text[shuffled], 4000)
    assert np.array_equal(again[0], wanted[0]) and np.array_equal(again[1], wanted[1])
    one, two = best(lambda: nj.distinct(tokens, text, 4000)), best(by_both)
    print(f"{one:.3f} s against {two:.3f} s")
    assert one < 0.7 * two
