import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import EDGES
from roadflow.llm import packing
from roadflow.llm.arrays import text_bytes
from roadflow.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "'s", "'re", "'", "''", " ", "  ", "\n", "\n\n", "\t", "a", "bc", "Z", "é", "ñ", "1", "23", ".", ",", "!?", "the",
    " 's", "'ll", "'LL", "\u0085", " ", "中", "が", "ሴ", "😀", "<|endoftext|>", "-", "_", "Ⅷ", "²", "\x1c", "\r\n",
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def test_ids_are_the_tokenizers(encoder):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + ["", "don't we'll 've"]
    ids, begins = encoder.encode(*text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[begins[k] : begins[k + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_lower_bound_holds_and_best_fit_respects_the_capacity():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = rng.integers(1, 101, rng.integers(1, 80))
        place, offset, room = packing.best_fit_decreasing(lengths, 100)
        assert packing.lower_bound(lengths, 100) <= len(room)
        for k in range(len(room)):
            own = np.flatnonzero(place == k)
            own = own[np.argsort(offset[own])]
            assert (offset[own] == np.concatenate([[0], np.cumsum(lengths[own])[:-1]])).all()
            assert lengths[own].sum() == 100 - room[k]
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3
    assert packing.lower_bound(np.zeros(0, np.int64), 100) == 0


def check(rows, docs, encoder, capacity, group):
    got = packing.documents_packed(docs, PATH, capacity, group).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        assert sum(r.length for r in own) == len(ids) and all(r.length == capacity for r in own[1:])
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // capacity)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return got, len(sequences)


def test_packed_documents_round_trip(small, encoder):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got, used = check(rows, small, encoder, 1024, 50_000)
    assert used <= 1.02 * sum(r.length for r in got) / 1024 + 1


def test_small_groups_exchange(small, encoder):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got, used = check(rows, small, encoder, 1024, 20)
    assert used <= 1.06 * sum(r.length for r in got) / 1024 + 1


def test_edges(docs_of, encoder):
    rows = [r for r in EDGES if r[0] is not None] + [(None, "null id text")]
    check(rows, docs_of(rows), encoder, 1024, 50_000)
    twice = docs_of([(1, "same"), (1, "same")])
    assert len(packing.documents_packed(twice, PATH).select("sequence_id", "offset").distinct().collect()) == 2
    assert packing.documents_packed(docs_of([]), PATH).count() == 0
