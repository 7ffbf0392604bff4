import hashlib
import re

import pytest
from conftest_llm import EDGES
from roadflow.llm import fill_middle as fm


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    said = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(said[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


TEXTS = ["Hello, wörld! 12\n\tnew  line", "日本語 text 🙂🙂 end", "<P", "a<P>b", "<", "<<S", "P> S>", "é", "x" * 5000, "ends with <M", "\u0000 nul"]


def test_forms_agree_with_brute_force(docs_of):
    rows = EDGES + [(100 + k, TEXTS[k % len(TEXTS)]) for k in range(300)] + [(100, TEXTS[0])]
    got = fm.transformed(docs_of(rows))
    found = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got.collect()), key=repr)
    assert found == sorted(((k, *brute(k, t)) for k, t in rows), key=repr)
    assert {f[2] for f in found} == {"plain", "psm", "spm"}


def test_every_output_gives_its_text_back(docs_of):
    rows = EDGES + [(100 + k, TEXTS[k % len(TEXTS)]) for k in range(200)]
    got = fm.restored(fm.transformed(docs_of(rows)))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(((k, t or "") for k, t in rows), key=repr)


def test_digests_are_those_of_output_and_text(docs_of):
    rows = EDGES + [(100 + k, TEXTS[k % len(TEXTS)]) for k in range(100)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted(((r.doc_id, r.output_sha256, r.restored_sha256) for r in fm.digests(docs_of(rows)).collect()), key=repr)
    assert got == sorted(((k, sha(brute(k, t)[4]), sha(t or "")) for k, t in rows), key=repr)


@pytest.mark.parametrize("form", ["psm", "spm", "plain"])
def test_pieces(form):
    text = memoryview("one <two three".encode())
    doc = fm.Pieces.whole(text).cut(3, 8) if form != "plain" else fm.Pieces.whole(text)
    assert b"".join(doc.chunks()) == bytes(text) and doc.arranged(form).restored(form).table == doc.table
    assert fm.parsed(doc.arranged(form).joined(), form).restored(form).joined() == bytes(text)
    assert all(0 <= a <= b for _, a, b in doc.arranged(form).table)


def test_empty_table(docs_of):
    assert fm.digests(docs_of([])).count() == 0
    assert fm.restored(fm.transformed(docs_of([]))).count() == 0
