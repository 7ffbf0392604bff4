"""Bytes of long repeated strings, removed wherever they occur.

Every batch of texts that a task gathers gets a sparse suffix array: the suffixes at the anchors of ``repeats``, sorted
by what follows and surrounds them within a window. The arrays are split by hash into buckets, and each bucket keeps a
logarithmic family of levels: an array is merged with the level of its size, which brings equal contexts together, and
levels double as they merge. Long matches that end inside a context are found by the windows around it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadflow.llm.arrays import text_bytes
from roadflow.llm.repeats import Units, covered, judged, repeated_spans

WINDOW, PREFIX = 200, 48


def without_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary) and kept_sha256.

    A byte of the UTF-8 text goes when it lies in a string of 200 bytes that also starts anywhere else, the same
    document included; strings never cross documents. Null texts are empty. Repeated rows repeat each other, so all of
    them lose their long strings; rows that share a doc_id must be such repeats. Other columns are not read.
    """
    units = Units("bytes", window, prefix, "anywhere")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, first = text_bytes(batch.column(2))
        gone = covered(first, batch.column(3), batch.column(4))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        edges = first[:-1][np.diff(first) > 0]
        begins[edges] = gone[edges]
        spans = np.concatenate([[0], np.cumsum(begins)])[first]
        at = np.concatenate([[0], np.cumsum(~gone)])[first]
        raw = data[~gone].tobytes()
        kept = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(1),
                pa.array(np.diff(first), pa.int64()),
                pa.array(np.diff(first) - np.diff(at), pa.int64()),
                pa.array(np.diff(spans), pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return judged(docs, repeated_spans(docs, units), each, schema)
