"""Repeated word sequences, removed from all documents but the one with the smallest id.

Suffixes are taken at the anchors of ``repeats`` and split by the hash of their prefix into groups of about equal size;
within a group they are sorted, which puts the leaves of each subtree side by side: equal anchors first, then equal
contexts. A prefix with very many contexts is lengthened to the whole context before suffixes are split. A subtree whose
leaves agree over a whole context is settled; where it branches inside a window, windows are split by prefix and sorted
anew, or by the whole window where a prefix has very many.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadflow.llm.arrays import NOT_SPACE, ranges, text_bytes, words
from roadflow.llm.repeats import Units, covered, judged, repeated_spans

WINDOW, PREFIX = 13, 5


def without_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the kept words, joined by single spaces) and kept_sha256.

    Words are runs without white space, unchanged. A word goes when it lies in a window of 13 words whose sequence also
    starts in a document with a smaller doc_id. Null and empty texts have no words. A null doc_id counts as larger
    than any other; rows with the same doc_id are repeats of one document and lose nothing to each other. Other columns
    are not read.
    """
    units = Units("words", window, prefix, "earlier", 1 << 20)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(2))
        starts, ends, first = words(data, offsets, NOT_SPACE)
        gone = covered(first, batch.column(3), batch.column(4))
        n_words, kept_first = np.diff(first), np.concatenate([[0], np.cumsum(~gone)])[first]
        lengths = (ends - starts)[~gone]
        flat = np.append(data, np.uint8(32))[ranges(starts[~gone], lengths + 1)]
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        flat[begins[1:] - 1] = 32
        raw, at = flat.tobytes(), begins[kept_first]
        kept = [raw[a : max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(1),
                pa.array(n_words, pa.int64()),
                pa.array(n_words - np.diff(kept_first), pa.int64()),
                pa.array([k.decode() for k in kept], pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept string, kept_sha256 string"
    return judged(docs, repeated_spans(docs, units), each, schema)
