"""Fill-in-the-middle forms of documents by piece tables.

A document is a table of pieces, each a stretch (buffer, start, stop) of one of two buffers that never change: the text
and the sentinels. Cutting splits the text's piece in three; a form is an order of those and the sentinels; the inverse
order gives the text back. Digests and outputs run over the pieces, no text is joined before its output is wanted.

Units are words of A-Z and a-z, and every other character by itself. The cuts and the form of a document follow from its
doc_id alone, so a rerun, on any number of executors, gives the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import giving_back, in_small_batches, pieces, text_bytes

SEED = 1
PREFIX, SUFFIX, MIDDLE = SENTINELS = (b"<P>", b"<S>", b"<M>")
PLAIN_FROM = 90  # of 100: documents that stay plain
SPM_BELOW = 20  # of 100: of the others, those that begin with the suffix
TEXT, MARKS = 0, 1  # buffers
MARK_BUFFER = b"".join(SENTINELS)
MARK = {m: (MARKS, MARK_BUFFER.index(m), MARK_BUFFER.index(m) + len(m)) for m in SENTINELS}
# Places 0, 1, 2 stand for the parts in the order of the text.
ORDERS = {"psm": [PREFIX, 0, SUFFIX, 2, MIDDLE, 1], "spm": [SUFFIX, 2, PREFIX, 0, MIDDLE, 1]}


@dataclass(frozen=True)
class Pieces:
    """A document as stretches (buffer, start, stop) of its text and of the sentinels."""

    text: memoryview
    table: tuple[tuple[int, int, int], ...]

    @classmethod
    def whole(cls, text: memoryview) -> Pieces:
        return cls(text, ((TEXT, 0, len(text)),))

    def cut(self, *places: int) -> Pieces:
        """The text's only piece, split at byte positions."""
        ((_, start, stop),) = self.table
        edges = [start, *places, stop]
        return Pieces(self.text, tuple((TEXT, a, b) for a, b in zip(edges, edges[1:])))

    def arranged(self, form: str) -> Pieces:
        """Three parts in the order of a form, between its sentinels; plain is the order they have."""
        order = ORDERS.get(form)
        if order is None:
            return self
        return Pieces(self.text, tuple(MARK[o] if isinstance(o, bytes) else self.table[o] for o in order))

    def restored(self, form: str) -> Pieces:
        """The pieces of the text of an arranged document, by the inverse order."""
        order = ORDERS.get(form)
        if order is None:
            return self
        return Pieces(self.text, tuple(self.table[order.index(k)] for k in range(3)))

    def chunks(self) -> Iterator[memoryview]:
        marks = memoryview(MARK_BUFFER)
        for buffer, start, stop in self.table:
            yield (self.text if buffer == TEXT else marks)[start:stop]

    def digest(self) -> str:
        running = hashlib.sha256()
        for chunk in self.chunks():
            running.update(chunk)
        return running.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.chunks())


def parsed(output: bytes, form: str) -> Pieces:
    """Pieces of an output from its bytes and its form alone: the sentinels are found, as no arranged text holds one."""
    order = ORDERS.get(form)
    if order is None:
        return Pieces.whole(memoryview(output))
    table, at = [], 0
    for part in order:
        if isinstance(part, bytes):
            found = output.index(part, at)
            if table or found:
                table.append((TEXT, at, found))
            at = found + len(part)
            table.append((TEXT, found, at))
    table.append((TEXT, at, len(output)))
    return Pieces(memoryview(output), tuple(table))


def numbers(doc_id: object) -> list[int]:
    """Four numbers that depend on the seed and the id only; a null id counts as empty."""
    said = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(said[k : k + 8], 16) for k in range(0, 32, 8)]


def form_of(text: bytes, third: int, fourth: int) -> str:
    if not text or third % 100 >= PLAIN_FROM or any(m in text for m in SENTINELS):
        return "plain"
    return "spm" if fourth % 100 < SPM_BELOW else "psm"


def _is_letter() -> np.ndarray:
    codes = np.arange(256)
    return ((codes >= 65) & (codes <= 90)) | ((codes >= 97) & (codes <= 122))


LETTER = _is_letter()


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all units of UTF-8 texts, the index of each text's first, and characters before every byte."""
    heads = (data & 0xC0) != 0x80
    letter = LETTER[data]
    goes_on = np.zeros(len(data), bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    edges = offsets[offsets < len(data)]
    goes_on[edges] = False
    starts = np.flatnonzero(heads & ~goes_on)
    return starts, np.searchsorted(starts, offsets), np.concatenate([[0], np.cumsum(heads)])


OUTPUT = ["n long", "form string", "prefix_chars long", "middle_chars long"]


def _mapped(docs: DataFrame, extra: list[tuple[str, pa.DataType]], more) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the columns ``extra``, from ``more``(cut pieces, form)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, first, chars = units(part, at)
                ends = np.append(starts, len(part))
                view = memoryview(part.tobytes())
                rows = []
                for k, doc_id in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    begin, stop, n = int(at[k]), int(at[k + 1]), int(first[k + 1] - first[k])
                    one, two, three, four = numbers(doc_id)
                    text = view[begin:stop]
                    form = form_of(bytes(text), three, four)
                    doc, prefix, middle = Pieces.whole(text), None, None
                    if form != "plain":
                        low, high = sorted((one % (n + 1), two % (n + 1)))
                        # The unit behind the last one begins where the text ends.
                        x, y = (stop if c == n else int(ends[first[k] + c]) for c in (low, high))
                        doc = doc.cut(x - begin, y - begin)
                        prefix, middle = int(chars[x] - chars[begin]), int(chars[y] - chars[x])
                    rows.append((n, form, prefix, middle, *more(doc, form)))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[kind for _, kind in extra]]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", *[name for name, _ in extra]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *OUTPUT, *[f"{name} string" for name, _ in extra]])
    return in_small_batches(docs).select("doc_id", F.col("text").cast("string")).mapInArrow(giving_back(run), schema)


def transformed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars and ``output``.

    The two lengths are in characters, null for plain. A null or empty text is plain and empty; a text that holds a sentinel is
    plain; a null doc_id draws as an empty one, repeated rows give equal rows. Other columns are not read.
    """

    def more(doc: Pieces, form: str) -> tuple:
        return (doc.arranged(form).joined().decode("utf-8"),)

    return _mapped(docs, [("output", pa.string())], more)


def digests(docs: DataFrame) -> DataFrame:
    """As ``transformed``, with digests in place of the output: output_sha256, and restored_sha256 of the text that is
    rebuilt from the output's bytes and its form."""

    def more(doc: Pieces, form: str) -> tuple:
        arranged = doc.arranged(form)
        return arranged.digest(), parsed(arranged.joined(), form).restored(form).digest()

    return _mapped(docs, [("output_sha256", pa.string()), ("restored_sha256", pa.string())], more)


def restored(forms: DataFrame) -> DataFrame:
    """``forms`` (with ``form`` and ``output``) and the ``text`` that was transformed; other columns stay."""

    @F.pandas_udf("string")
    def text(outputs: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([parsed(o.encode(), f).restored(f).joined().decode() for o, f in zip(outputs, kinds)], dtype=object)

    return forms.withColumn("text", text("output", "form"))
