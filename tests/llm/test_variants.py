import re
import zlib
from collections import Counter

from conftest_llm import EDGES
from roadflow.llm import variants as v


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows, every=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, every=97):
    n = counted(rows, every)
    out, form = {}, {}
    for w in n:
        around = [u for u in n if u != w and near(w, u)]
        best = min(around, key=lambda u: (-n[u], u.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(around)
    result = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, n[w], out[w], form[w], n[form[w]] if form[w] else None, root))
    return sorted(result, key=repr)


def rows_of(df):
    return sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()), key=repr)


def test_variants_agree_with_brute_force_on_documents(small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert rows_of(v.variants(small)) == brute(rows)
    few = brute(rows, 5)
    assert rows_of(v.variants(small, 5)) == few and any(r[3] for r in few)


def test_repeated_characters_chains_and_ties(docs_of):
    words = {
        "hello": 40, "helo": 9, "hellllo": 3, "helllo": 9, "hallo": 40, "hullo": 3, "hell": 50, "hells": 20,
        "aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "aaaaaaaa": 31, "baaaaa": 4, "abaaaa": 4, "ÀÉÎõü": 5, "ÀÉÎõ": 9, "ÀÉÎõüy": 12,
        "straße": 6, "strasse": 30, "strase": 3, "abcdef": 3, "abcdeg": 3, "bcdefa": 3, "xabcde": 6, "abcde": 3,
    }
    rows = EDGES + [(20 + k, " ".join([w] * (n // 2)) + "\n" + ",".join([w.upper() if w.isascii() else w] * (n - n // 2))) for k, (w, n) in enumerate(words.items())]
    expected = brute(rows, 10**9)
    assert rows_of(v.variants(docs_of(rows), 10**9)) == expected
    assert any(r[5] != r[3] and r[3] for r in expected)  # a chain of forms
    assert rows_of(v.variants(docs_of(rows), 3)) == brute(rows, 3)


def test_groups_are_bounded_by_the_alphabet(spark):
    letters = [chr(c) for c in range(97, 123)]
    words = spark.createDataFrame([(f"w{a}rd{b}", 5 + ord(a)) for a in letters for b in letters], "word string, n long")
    got = {r.word: r for r in v.neighbours(words).collect()}
    assert len(got) == 676 and all(r.n_near == 50 for r in got.values())
    assert got["wards"].best.word == "wzrds" and got["wzrds"].best.word == "wzrda"


def test_empty_and_null(docs_of):
    assert v.variants(docs_of([])).count() == 0
    assert v.variants(docs_of([(1, None), (None, "")])).count() == 0
    assert rows_of(v.variants(docs_of([(None, "weird weird weird")]))) == brute([(None, "weird weird weird")])
