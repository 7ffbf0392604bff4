"""Whole Arrow columns of text as numpy arrays: bytes, words and their 64-bit hashes.

A batch has at most ``BATCH_ROWS`` texts and is worked on in pieces of about a megabyte, so the buffers
and arrays of a task stay small; a text that is longer than a piece is a piece of its own and takes about 60 times its
length in memory.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 20
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
def worker_state() -> types.ModuleType:
    """What one Python process keeps from task to task; functions sent by value have no module of their own to do so."""
    return sys.modules.setdefault("_roadflow_worker_state", types.ModuleType("_roadflow_worker_state"))


def _factors(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``size`` of them or more."""
    state = worker_state()
    if len(getattr(state, "powers", ())) < size:
        wide = max(size, PIECE_BYTES + (PIECE_BYTES >> 2))

        def powers(base: int) -> np.ndarray:
            steps = np.full(wide, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        state.powers, state.inverses = powers(_BASE), powers(_INVERSE)
    return state.powers, state.inverses


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same table; its session sends at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` at a time to Python.

    These settings of the session stay; a smaller one that it has already is kept.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < _bytes(conf.get(key)) <= most:
            conf.set(key, str(most))
    return df


def _bytes(setting: str) -> int:
    digits = setting.strip().lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(digits[-1:], 1)
    return int(digits[:-1] if scale > 1 else digits) * scale


def giving_back(run):
    """``run`` (batches in, batches out), after which the worker returns the memory that the task has freed."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            gc.collect()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library; others have no need of it
            if trim is not None:
                trim(0)

    return whole


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins (one more at the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    if at is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together, at least one text each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


class Rolling:
    """Hashes of any stretch of an array from one running sum; equal stretches have equal hashes.

    The array holds bytes, or 64-bit hashes of larger units.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        codes = BYTE_CODES[data] if data.dtype == np.uint8 else data
        powers, self.inverses = _factors(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * powers[:n], dtype=np.uint64, out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, size: int) -> np.ndarray:
        """Of every stretch of ``size`` bytes, by its start."""
        n = len(self.sums) - 1
        if n < size:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[: n - size + 1]) * self.inverses[: n - size + 1])


SHORT_SPAN = 64


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every stretch: eight bytes at a time, each step mixed; long stretches by BLAKE2b."""
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + np.uint64(_BASE))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = np.flatnonzero((sizes > 0) & (sizes <= SHORT_SPAN))
    step = 0
    while len(left):
        rest = np.minimum(sizes[left] - step, 8)
        kept = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - rest) * 8).astype(np.uint64)
        out[left] = mix((out[left] ^ (eights[starts[left] + step] & kept)) * np.uint64(0x2545F4914F6CDD1D))
        step += 8
        left = left[sizes[left] > step]
    for k in np.flatnonzero(sizes > SHORT_SPAN).tolist():
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def lower_table() -> np.ndarray:
    """A-Z to a-z, every other byte to itself."""
    codes = np.arange(256, dtype=np.uint8)
    codes[65:91] += 32
    return codes


LOWER = lower_table()
_SPACES = [0x20, *range(0x09, 0x0E)]
NOT_SPACE = ~np.isin(np.arange(256), _SPACES)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``inside``, and the index of each text's first run.

    Runs never cross texts. The third array has one entry more than there are texts.
    """
    n = len(data)
    flags = inside[data]
    before = np.zeros(n, bool)
    before[1:] = flags[:-1]
    after = np.zeros(n, bool)
    after[:-1] = flags[1:]
    edges = offsets[offsets < n]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(flags & ~before)
    ends = np.flatnonzero(flags & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive hashes, by the first of them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + n]) * np.uint64(_BASE)
        out ^= out >> np.uint64(29)
    return mix(out)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every start, ``count`` numbers each, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(firsts - starts, counts)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every ``size`` consecutive values, by the first of them."""
    return _sliding(values, size, np.minimum)


def sliding_max(values: np.ndarray, size: int) -> np.ndarray:
    return _sliding(values, size, np.maximum)


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    if len(values) < size:
        return values[:0]
    have, out = 1, values
    while have * 2 <= size:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out
