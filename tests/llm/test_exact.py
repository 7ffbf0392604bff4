import hashlib

from conftest_llm import EDGES
from roadflow.llm import exact_dedup


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


ROWS = [(1, "Same text"), (2, "same TEXT"), (9, "same text"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "alone"), (8, "b"), (8, "b")]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[folded(text)]
        keep = max((i for i in own if i is not None), default=None)
        out.append((doc_id, keep, len(own), hashlib.sha256(folded(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_agree_with_brute_force(docs_of):
    rows = ROWS + EDGES + [(100 + i, "hot") for i in range(300)] + [(None, "lonely null"), (None, "lonely null")]
    got = exact_dedup.exact_groups(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({folded(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_small_sketch_gives_the_same(docs_of):
    rows = [(i, f"t{i % 40}") for i in range(400)] + [(1000 + i, "hot") for i in range(500)]
    few = exact_dedup.exact_groups(docs_of(rows), tracked=4).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in few), key=repr) == expected(rows)


def test_one_row_of_each_group_stays_with_all_columns(docs_of):
    docs = docs_of(ROWS)
    got = exact_dedup.without_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 4, 6, 7, 8, 9]


def test_empty_table(docs_of):
    assert exact_dedup.exact_groups(docs_of([])).count() == 0
    assert exact_dedup.without_copies(docs_of([])).count() == 0
