"""Benchmark passages in documents, found by spaced seeds.

A spaced seed is a fixed mask over consecutive words that ignores some positions, so a changed word there does not
break the hit. The hashes of all benchmark seeds are joined with those of every position of every document where the
documents are read; around each hit the two word sequences are compared along their diagonal, word by word, and the
best stretch (a match counts 1, a substitution ``-PENALTY``) must hold enough equal words. Of an item too short for that many,
the whole diagonal counts. Items too short for the masks have masks of their own, of their length; each ignores a third of it,
so that one changed word anywhere leaves a seed.

Words are runs of letters and digits. Scripts that are written without spaces give a word per character, and two such
characters are as much evidence as one word.

The benchmark is taken in blocks of at most ``BLOCK_WORDS`` words. Only one block at a time is held or sent, so its
size is bounded however large the benchmark is; a larger one means more passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import LOWER, Rolling, giving_back, in_small_batches, mix, pieces, text_bytes, words
from roadflow.llm.licences import INSIDE
from roadflow.session import staged

MASKS = ["111010011", "110101101", "101100111"]
LEAST_WORDS = 5  # shorter items are no evidence
ENOUGH = 13  # equal words that make an overlap; of shorter items, four fifths of their words
PENALTY = 3
BLOCK_WORDS = 1 << 20


# Scripts without spaces between words, as ranges of code points divided by 64: Thai, Lao, Myanmar, Khmer,
# ideographs with kana and their punctuation, compatibility ideographs. Ideographs of four bytes begin with F0 A0.
UNSPACED = [(0x38, 0x3B), (0x40, 0x42), (0x5E, 0x5F), (0xBA, 0x27F), (0x3E4, 0x3EB)]


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of scripts without spaces begin, and their sizes in bytes."""
    at = np.flatnonzero(data[:-2] >= 0xE0) if len(data) > 2 else np.zeros(0, np.int64)
    lead, second = data[at].astype(np.int64), data[at + 1].astype(np.int64)
    block = ((lead & 15) << 6) | (second & 63)
    three = np.zeros(len(at), bool)
    for low, high in UNSPACED:
        three |= (lead < 0xF0) & (block >= low) & (block <= high)
    four = (lead == 0xF0) & (second >= 0xA0)
    return at[three | four], np.where(four, 4, 3)[three | four]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, the index of each text's first word, and which words are single characters."""
    starts, ends, first = words(data, offsets, INSIDE)
    at, size = _characters(data)
    if not len(at):
        return starts, ends, first, np.zeros(len(starts), bool)
    after = at + size
    run = np.searchsorted(starts, after, "right") - 1
    cuts = np.union1d(starts, np.concatenate([at, after[after < ends[run]]]))
    limits = ends[np.searchsorted(starts, cuts, "right") - 1]
    stops = np.minimum(np.append(cuts[1:], len(data)), limits)
    return cuts, stops, np.searchsorted(cuts, offsets), np.isin(cuts, at)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first, single = _words(data, offsets)
    return Rolling(LOWER[data]).spans(starts, ends), first, single


def short_masks(n: int) -> list[str]:
    """Masks for items of ``n`` words; each ignores another third of them. Ignored ends are left off."""
    third = -(-n // 3)
    return ["".join("0" if k // third == part else "1" for k in range(n)).strip("0") for part in range(3)]


def least_equal(n: int) -> int:
    """Equal words that make an overlap with an item of ``n`` words."""
    return min(ENOUGH, -(-4 * n // 5))


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return mix(out)


def _whole(first: np.ndarray, n: int, span: int) -> np.ndarray:
    """Positions from which ``span`` words stay within their text."""
    inside = np.zeros(max(0, n - span + 1), bool)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= span:
            inside[a : b - span + 1] = True
    return inside


class Block:
    """Seeds of some benchmark items: for each mask the sorted hashes with their item and position."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        hashes, first, single = _word_hashes(data, offsets)
        sizes = np.diff(first)
        singles = np.diff(np.concatenate([[0], np.cumsum(single)])[first])
        evident = sizes - singles // 2 >= LEAST_WORDS
        self.ids, self.hashes, self.first = ids, hashes, first
        masks = {m: evident & (sizes > len(m)) for m in MASKS}
        for n in range(LEAST_WORDS, len(MASKS[0]) + 1):
            wanted = evident & (sizes == n)
            for m in short_masks(n) if wanted.any() else ():
                masks[m] = wanted | masks.get(m, False)
        self.tables = []
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for mask, wanted in masks.items():
            seeds = _seeds(hashes, mask)
            at = np.flatnonzero(_whole(first, len(hashes), len(mask)) & wanted[owner[: len(seeds)]]) if len(seeds) else []
            if not len(at):
                continue
            order = np.argsort(seeds[at], kind="stable")
            at = at[order]
            bits = max(16, int(np.ceil(np.log2(len(at) * 16))))
            seen = np.zeros(1 << bits, bool)
            seen[seeds[at] >> np.uint64(64 - bits)] = True
            self.tables.append((mask, seeds[at], at, owner[at], bits, seen))

    def overlaps(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, equal words, first word in the text, words compared), the best of each text and item."""
        hashes, first, _ = _word_hashes(data, offsets)
        found = []
        for mask, keys, at, owner, bits, seen in self.tables:
            seeds = _seeds(hashes, mask)
            hits = np.flatnonzero(seen[seeds >> np.uint64(64 - bits)])
            low = np.searchsorted(keys, seeds[hits], "left")
            many = np.searchsorted(keys, seeds[hits], "right") - low
            hits, low, many = hits[many > 0], low[many > 0], many[many > 0]
            if not len(hits):
                continue
            text = np.searchsorted(first, hits, "right") - 1
            good = hits + len(mask) <= first[text + 1]
            hits, low, many, text = hits[good], low[good], many[good], text[good]
            for k in range(int(many.max(initial=0))):  # the same seed at several places of the benchmark
                more = many > k
                rows = low[more] + k
                item = owner[rows]
                found.append(np.stack([text[more], item, hits[more] - (at[rows] - self.first[item])], axis=1))
        if not found:
            return []
        best: dict[tuple[int, int], tuple] = {}
        for text, item, origin in np.unique(np.concatenate(found), axis=0):
            stretch = self._stretch(hashes, first[text], first[text + 1], item, origin)
            if stretch and stretch > best.get((text, item), (0,)):
                best[text, item] = stretch
        return [(int(t), int(i), *map(int, stretch)) for (t, i), stretch in sorted(best.items())]

    def _stretch(self, hashes, begin, end, item, origin) -> tuple | None:
        own = self.hashes[self.first[item] : self.first[item + 1]]
        low, high = max(begin, origin), min(end, origin + len(own))
        equal = hashes[low:high] == own[low - origin : high - origin]
        if len(own) * 4 <= ENOUGH * 5:
            at = np.flatnonzero(equal)
            start, stop = int(at[0]), int(at[-1]) + 1
        else:
            sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
            floor = np.minimum.accumulate(sums)
            stop = int(np.argmax(sums - floor))
            start = int(np.flatnonzero(sums[: stop + 1] == floor[stop])[-1])
        matched = int(equal[start:stop].sum())
        if matched < least_equal(len(own)):
            return None
        return matched, low - begin + start, stop - start


def blocks(benchmark: DataFrame, size: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of about ``size`` words, read row by row; null texts are skipped."""
    ids, texts, total = [], [], 0
    for row in benchmark.select("item_id", "text").filter("text is not null").toLocalIterator():
        n = len(row["text"]) // 2 + 1  # no text has more words
        if ids and total + n > size:
            yield Block(ids, texts)
            ids, texts, total = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        total += n
    if ids:
        yield Block(ids, texts)


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, item_id, n_equal, n_compared, first_word.

    Documents without an overlap give no row; null and empty texts have none, and an empty benchmark gives no rows.
    Repeated documents are reported each. Other columns are not read. Items under five words, or ten characters of a script
    without spaces, are no evidence.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, n_equal long, n_compared long, first_word long"
    rows = in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def against(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                for a, b in pieces(offsets):
                    found = block.overlaps(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    if found:
                        at = pa.array([a + f[0] for f in found], pa.int64())
                        items = pa.array([block.ids[f[1]] for f in found])
                        rest = [pa.array([f[k] for f in found], pa.int64()) for k in (2, 4, 3)]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(at), items, *rest],
                            ["doc_id", "item_id", "n_equal", "n_compared", "first_word"],
                        )

        return run

    out = None
    for block in blocks(benchmark, block_words):
        part = rows.mapInArrow(giving_back(against(block)), schema)
        out = part if out is None else staged(out, "overlaps").unionByName(staged(part, "overlaps"))
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without those that overlap a benchmark item; the columns stay as they are."""

    def clean(block: Block):
        @F.pandas_udf("boolean")
        def free(texts: pd.Series) -> pd.Series:
            data, offsets = text_bytes(pa.array(texts, pa.large_string()))
            keep = np.ones(len(texts), bool)
            for a, b in pieces(offsets):
                found = block.overlaps(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                keep[[a + f[0] for f in found]] = False
            return pd.Series(keep)

        return free

    docs = in_small_batches(docs)
    for k, block in enumerate(blocks(benchmark, block_words)):
        docs = staged(docs, "decontaminated") if k else docs
        docs = docs.filter(clean(block)(F.coalesce("text", F.lit(""))))
    return docs
