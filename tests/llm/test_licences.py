import random
import re

import pytest
from conftest_llm import EDGES
from roadflow.llm import licences


@pytest.mark.parametrize(
    "text, order",
    [
        ("MIT", ["mit"]),
        ("MIT OR Apache-2.0 AND ISC", ["mit", "apache-2.0", "isc", "and", "or"]),
        ("(MIT OR Apache-2.0) AND GPL-2.0+ rest", ["mit", "apache-2.0", "or", "gpl-2.0+", "and"]),
        ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "or"]),
        ("MIT OR", ["mit"]),
        ("MIT.", ["mit"]),
        ("OR MIT", None),
        ("", None),
        ("((MIT", ["mit"]),
        ("MIT))", ["mit"]),
    ],
)
def test_postfix(text, order):
    assert licences.postfix(text) == order


def test_evaluated():
    def free(text):
        return licences.evaluated(licences.postfix(text))

    assert free("MIT OR GPL-3.0") == (True, {"mit", "gpl-3.0"})
    assert free("MIT AND GPL-3.0")[0] is False
    assert free("MIT AND (GPL-3.0 OR ISC)")[0] is True
    assert free("Apache-2.0 WITH LLVM-exception") == (True, {"apache-2.0"})


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licences.BASE.items():
        parts = phrase.split()
        for s in range(len(words) - len(parts) + 1):
            if words[s : s + len(parts)] == parts:
                places.append(s)
                labels.add(label)
    low, high = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), low, high, ",".join(sorted(labels))


def agree(docs, rows):
    got = licences.scanned(docs).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr)
    assert found == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    return {r.doc_id: r for r in got}


def test_base_agrees_with_brute_force(docs_of):
    rng = random.Random(4)
    bits = ["CC", "cc", "by", "By", "general", "public", "License", "all rights reserved", "é", "x1", "écc", "by9", "cc by cc by"]
    rows = [(k, "".join(rng.choice(bits) + rng.choice([" ", "-", ".\n", "  "]) for _ in range(rng.randint(0, 20)))) for k in range(300)]
    agree(docs_of(rows), rows)


def test_whole_documents(small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got = agree(small, rows)
    for doc_id, text in rows:
        if "Released under the MIT License" in text:
            assert "mit" in got[doc_id].labels.split(",")


def test_tags_and_edges(docs_of):
    rows = EDGES + [
        (30, "// SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-3.0)\nall rights reserved"),
        (31, "SPDX-License-Identifier: GPL-3.0 AND MIT"),
        (32, "spdx-license-identifier:"),
        (30, "repeated"),
    ]
    got = licences.scanned(docs_of(rows)).collect()
    agree(docs_of(rows), rows)
    by = {r.doc_id: r for r in got if r.n_words != 1}
    assert by[30].labels == "apache-2.0,gpl-3.0,mit,reserved" and by[30].permitted is True and by[30].score > 0.95
    assert by[31].permitted is False and by[32].labels == "" and by[32].score == 0
    assert licences.scanned(docs_of([])).count() == 0


def test_an_expression_of_several_kilobytes_is_read_to_its_line_end(docs_of):
    names = [f"LicenseRef-part{k}" for k in range(300)]
    line = "SPDX-License-Identifier: MIT OR " + " OR ".join(names)
    rows = [(1, f"{line}\nOR ISC"), (2, "SPDX-License-Identifier: " + "MIT AND " * 700 + "GPL-3.0"), (3, "ISC")]
    got = {r.doc_id: r for r in licences.scanned(docs_of(rows, 1)).collect()}
    assert set(got[1].labels.split(",")) == {"mit", *map(str.lower, names)}
    assert got[2].permitted is False and got[2].labels == "gpl-3.0,mit" and got[3].labels == ""
