import random
import re

import numpy as np
from conftest_llm import EDGES
from roadflow.llm import personal_data as pd_


def luhn(digits):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(digits))) % 10 == 0


def brute(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(6)
    bits = ["a", "b.c", "@", "@x.y", ".", "1", "25", "255", "256", "0007", "4111", "1111 1111", "-", " ", "+", "+49", "(0)", "é", "%", "_"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert pd_.base_spans(text) == brute(text), text
    for text in ["4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "x@" * 50 + "y.z", "+1 (988) 555-2485."]:
        assert pd_.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for run in ("1" * 300_000, "a" * 300_000, "1." * 100_000, "a@" * 100_000, "1 " * 100_000, "a=" * 100_000):
        pd_.base_spans(run)
        pd_.candidates(run, [])


def test_whole_documents(small):
    for r in pd_.scanned(small).join(small.select("doc_id", "text"), "doc_id").collect():
        assert [(s.kind, s.start, s.stop) for s in r.base] == brute(r.text)
        assert all(not any(b.start < f.stop and f.start < b.stop for b in r.base) for f in r.found)


def test_patterns_of_seeds_find_other_identifiers(docs_of):
    rows = [(100 + k, f"text contact: user{k}@mail.org and more") for k in range(8)]
    rows += [(20, "contact: agent-007x here"), (21, "note: chapter-2024 here"), (22, "api_key = 'ab12cd34ef' end")]
    rows += [(30 + k, f"note: word{'s' * k} only") for k in range(6)] + EDGES
    got = {r.doc_id: r for r in pd_.scanned(docs_of(rows)).collect()}
    text = dict(rows)

    def found(k):
        return [text[k][s.start : s.stop] for s in got[k].found]

    assert found(20) == ["agent-007x"] and found(21) == [] and found(22) == ["ab12cd34ef"]
    assert all(not r.base and not r.found for k, r in got.items() if k in (1, 2, 3, 4, 5, 6, None))


def test_empty_and_repeated(docs_of):
    assert pd_.scanned(docs_of([])).count() == 0
    got = pd_.scanned(docs_of([(1, "a@b.cc"), (1, "a@b.cc")])).collect()
    assert [[s.kind for s in r.base] for r in got] == [["email"], ["email"]]


PROSE = "the of and thing eder anhein ouer stion ther inerly reand shor".split()


def prose(rng, n):
    return " ".join(rng.choice(PROSE) for _ in range(n)) + rng.choice([" ", ". "])


def test_seeds_alone_find_identifiers_in_prose(docs_of, monkeypatch):
    monkeypatch.setattr(pd_, "CUES", set())
    rng = random.Random(3)
    rows = [(k, prose(rng, 30) + f"please write to user{k}@mail.org about" + " it. " + prose(rng, 30)) for k in range(8)]
    rows += [(10 + k, prose(rng, 30) + f"é (\n call  +49 30 12345{k}{k} today) " + prose(rng, 20)) for k in range(8)]
    rows += [(20, prose(rng, 9) + "Please write  to memb-4471x about it."), (21, prose(rng, 9) + "é ( CALL desk0077 today) the")]
    rows += [(30 + k, prose(rng, 40) + f"chapter{k}{k + 100} " + prose(rng, 9)) for k in range(8)]
    text = dict(rows)
    got = {r.doc_id: [text[r.doc_id][s.start : s.stop] for s in r.found] for r in pd_.scanned(docs_of(rows)).collect()}
    assert {k: v for k, v in got.items() if v} == {20: ["memb-4471x"], 21: ["desk0077"]}


def test_rounds_and_support_revise_cues(docs_of):
    rows = [(k, f"the key: {w} is") for k, w in enumerate(["of", "music", "major", "minor", "abc123def"])]
    assert all(not r.found for r in pd_.scanned(docs_of(rows)).collect())
    rows = [(1, "a token = 'ab12cd34'")]
    assert [len(r.found) for r in pd_.scanned(docs_of(rows), support=2).collect()] == [1]
    assert [len(r.found) for r in pd_.scanned(docs_of(rows), support=3).collect()] == [0]


def test_plain_occurrences_of_hopeful_patterns_are_enough(docs_of, monkeypatch):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(120):
        number, word = f"AB{rng.integers(10**6):06d}", f"word{rng.integers(9)}"
        rows.append((k, f"write to user{k}@mail.example.org or call. case id {number if k % 3 else word} was {word} here"))
        rows.append((1000 + k, f"mail to {'user%d@mail.example.org' % k if k % 4 else number} now, {word} and {number}"))
    docs = docs_of(rows)
    found = pd_.scanned(docs).select("doc_id", "found").collect()
    # The same with plain occurrences of every pattern that has the support.
    kept = pd_._rounds
    monkeypatch.setattr(pd_, "_rounds", lambda graph, *a: [graph.filter("shaped").select("pattern").distinct(), *kept(graph, *a)])
    assert sorted(map(repr, pd_.scanned(docs).select("doc_id", "found").collect())) == sorted(map(repr, found))
    assert any(r.found for r in found)


def test_parts_refute_as_the_whole_does(docs_of, monkeypatch):
    rng = np.random.default_rng(12)
    rows = []
    for k in range(200):
        number = f"AB{rng.integers(10**6):06d}"
        rows.append((k, f"write to user{k}@mail.example.org or call. room {rng.integers(12)} of {number if k % 5 else 'none'} {k}"))
        if k % 10 == 0:
            rows.append((1000 + k, f"call. room {rng.integers(12)} of {number if k % 20 else 'some'} or write to desk-{k:05d} or call. now"))
    docs = docs_of(rows)
    found = pd_.scanned(docs).select("doc_id", "found").collect()
    monkeypatch.setattr(pd_, "PARTS", [64])
    assert sorted(map(repr, pd_.scanned(docs).select("doc_id", "found").collect())) == sorted(map(repr, found))
    assert any(r.found for r in found)


def test_counted_patterns_are_all_that_occur(docs_of):
    """The bit table may pass more than the patterns, never fewer."""
    docs = docs_of([(k, f"write to the word{k % 7} of the day{k % 3} or not") for k in range(60)])
    text = "write to the word1 of the day1 or not".encode()
    units = pd_.Surroundings(np.frombuffer(text, np.uint8), np.array([0, len(text)]), [[]])
    wanted = sorted(set(units.patterns(np.arange(len(units.starts))).view(np.int64).ravel().tolist()) - {0})
    patterns = docs.sparkSession.createDataFrame([(p,) for p in wanted], "pattern long")
    got = {r.pattern: r.n for r in pd_._others(docs, patterns).join(patterns, "pattern").collect()}
    counts = {}
    for row in docs.collect():
        data = np.frombuffer(row.text.encode(), np.uint8)
        own = pd_.Surroundings(data, np.array([0, len(data)]), [[]])
        for p in own.patterns(np.arange(len(own.starts))).view(np.int64).ravel().tolist():
            counts[p] = counts.get(p, 0) + 1
    assert got == {p: counts[p] for p in wanted if p in counts}
