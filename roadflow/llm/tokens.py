"""Token ids of whole texts by a byte-level tokenizer file.

The texts of a piece are split into pre-tokens with array operations; every distinct pre-token is encoded once by the
tokenizer and remembered by the worker, at most ``REMEMBERED`` at a time. Texts with characters outside the scripts
listed in ``SETTLED`` (their class may differ between Unicode versions) or with a special token's name are encoded by
the tokenizer as they are, so all ids are the tokenizer's.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from roadflow.llm.arrays import Rolling, ranges, worker_state

REMEMBERED = 500_000
# Latin, Greek, Cyrillic, kana, common Han and Hangul syllables.
SETTLED = [(0x0000, 0x052F), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0]
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]  # of contractions, after an apostrophe


def _classes() -> tuple[np.ndarray, np.ndarray]:
    kinds = {"L": LETTER, "N": NUMBER}
    top = max(b for _, b in SETTLED) + 1
    codes = np.full(top, OTHER, np.uint8)
    settled = np.zeros(top, bool)
    for a, b in SETTLED:
        settled[a : b + 1] = True
        codes[a : b + 1] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(a, b + 1)]
        for c in range(a, b + 1):  # characters that got a category after the first table are left to the tokenizer
            settled[c] &= unicodedata.category(chr(c)) != "Cn"
    codes[_SPACES] = SPACE
    settled[0x1C:0x20] = False
    return codes, settled


class Encoder:
    """Encodes pieces of text; keeps the ids of pre-tokens between calls."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes, self.settled = _classes()
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begins = np.zeros(1 << 14, np.int64)

    @staticmethod
    def of_worker(path: str) -> Encoder:
        state = worker_state()
        if getattr(state, "path", None) != path:
            state.encoder, state.path = Encoder(path), path
        return state.encoder

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        at, used = len(self.rows), int(self.begins[len(self.rows)])
        coded = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        sizes = np.array([len(c) for c in coded], np.int64)
        need, rows = used + int(sizes.sum()), at + len(texts) + 1
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.uint32)])
        if rows > len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros(max(rows, len(self.begins)), np.int64)])
        self.ids[used:need] = np.concatenate([np.array(c, np.uint32) for c in coded]) if need > used else []
        self.begins[at + 1 : rows] = used + np.cumsum(sizes)
        self.rows.update(zip(hashes.tolist(), range(at, rows - 1)))

    def _pretokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte position of every pre-token, and for each text whether its characters are all settled."""
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        firsts = np.searchsorted(heads, offsets)
        n = len(points)
        low = np.minimum(points, len(self.classes) - 1)
        usual = self.settled[low] & (points < len(self.classes))
        odd = np.concatenate([[0], np.cumsum(~usual)])
        fine = odd[firsts[1:]] == odd[firsts[:-1]]
        kinds = self.classes[low]
        edge = np.zeros(n + 1, bool)
        edge[firsts] = True
        begin = edge.copy()
        begin[1:n] |= kinds[1:] != kinds[:-1]
        # Places where a run of white space ends before something else of the same text.
        ends = np.flatnonzero(begin[1:n] & ~edge[1:n] & (kinds[: n - 1] == SPACE)) + 1
        plain = points[ends - 1] == 32
        begin[ends - 1] = True
        begin[ends[plain]] = False
        marks = np.flatnonzero(begin[:n] & (points == 39))
        reach = np.append(points, np.zeros(4, np.uint32))
        limit = firsts[np.searchsorted(firsts, marks, "right")] if len(marks) else marks
        done = np.zeros(len(marks), bool)
        for suffix in SUFFIXES:
            hit = ~done & (marks + len(suffix) < limit)
            for k, letter in enumerate(suffix, 1):
                hit &= reach[marks + k] == ord(letter)
            begin[marks[hit] + 1] = False
            begin[marks[hit] + 1 + len(suffix)] = True
            done |= hit
        return heads[np.flatnonzero(begin[:n])], fine

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (one more at the end)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, fine = self._pretokens(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = Rolling(data).spans(starts, ends)
        keys, place, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.rows) + len(keys) > REMEMBERED:
            self._forget()
        known = self.rows
        missing = np.array([k for k, h in enumerate(keys.tolist()) if h not in known], np.int64)
        if len(missing):
            raw = data.tobytes()
            at = place[missing]
            self._learn(keys[missing], [raw[a:b].decode("utf-8") for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        rows = np.fromiter((known[h] for h in keys.tolist()), np.int64, len(keys))[which]
        begins = self.begins[rows]
        counts = self.begins[rows + 1] - begins
        ids = self.ids[ranges(begins, counts)]
        of_text = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        special = [t.encode() for t in self.special]
        whole = data.tobytes()
        if not fine.all() or any(s in whole for s in special):
            ids, of_text = self._exceptions(whole, offsets, fine, special, ids, of_text)
        return ids, of_text

    def _exceptions(self, raw, offsets, fine, special, ids, of_text):
        parts = []
        for k in range(len(fine)):
            text = raw[offsets[k] : offsets[k + 1]]
            if fine[k] and not any(s in text for s in special):
                parts.append(ids[of_text[k] : of_text[k + 1]])
            else:
                own = self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids
                parts.append(np.array(own, np.uint32))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
