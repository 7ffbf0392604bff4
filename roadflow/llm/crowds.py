"""Members of candidate groups of any size, compared across classes without a task that holds a whole group.

A group (``bucket``) may hold a large share of all rows, and most of its members may be in one class already. Members of
the largest class need not meet each other, so only the others travel: with n members of which r are outside the
largest class, n + r * n / ``BLOCK`` rows are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import giving_back

BLOCK = 256


def meetings(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Where members of buckets with several classes meet: ``placed`` (bucket, node, label, ...) and block, chunk, home.

    In a meeting (bucket, block, chunk) the members at ``home``, about ``block`` of them, meet those that are not, at most
    about ``block`` members outside the bucket's largest class. Every two members of different classes meet once with
    the larger class or the smaller node at home, and maybe once the other way round; see ``partners``.
    """
    sizes = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = (
        sizes.groupBy("bucket")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes"))
        .filter("classes > 1")
        .select("bucket", "n", (F.col("n") - F.col("top.n")).alias("others"), F.col("top.label").alias("largest"))
    )
    rows = placed.join(largest, "bucket").withColumn("spread", F.xxhash64("node"))
    blocks, chunks = (F.ceil(F.col(c) / block).cast("int") for c in ("n", "others"))
    own, part = F.pmod("spread", blocks).cast("int"), F.pmod("spread", chunks).cast("int")
    every_chunk = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(own.alias("block"), c.alias("chunk"), F.lit(True).alias("home")))
    every_block = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(b.alias("block"), part.alias("chunk"), F.lit(False).alias("home")))
    seats = F.when(F.col("label") == F.col("largest"), every_chunk).otherwise(F.concat(every_chunk, every_block))
    return rows.select(*placed.columns, (F.col("label") == F.col("largest")).alias("large"), F.explode(seats).alias("seat")).select(
        *placed.columns, "large", "seat.*"
    )


def partners(home: np.ndarray, large: np.ndarray, node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows at home, rows that travel, and which of their pairs belong to this meeting (a matrix)."""
    one, two = np.flatnonzero(home), np.flatnonzero(~home)
    fit = label[one][:, None] != label[two][None, :]
    fit &= large[one][:, None] | (node[one][:, None] < node[two][None, :])
    return one, two, fit


def scanned(rows: DataFrame, keys: Sequence[str], found: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``found`` of every group of ``keys`` (long or int columns); a task holds one group and one batch."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        tables = (pa.Table.from_batches([b]) for b in batches if b.num_rows)
        for table in chain(tables, [None]):
            if table is not None and held and _same(held[-1], len(held[-1]) - 1, table, len(table) - 1, keys):
                held.append(table)  # the open group goes on beyond this batch
                continue
            if table is not None:
                held.append(table)
            if not held:
                return
            whole = pa.concat_tables(held)
            new = np.zeros(len(whole), bool)
            for key in keys:
                values = whole.column(key).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            edges = [0, *np.flatnonzero(new).tolist(), len(whole)]
            last = len(edges) - 1 if table is None else len(edges) - 2
            for p, q in zip(edges[:last], edges[1 : last + 1]):
                batch = found(whole.slice(p, q - p))
                if batch is not None:
                    yield batch
            held = [whole.slice(edges[last])] if table is not None else []

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(giving_back(run), schema)


def _same(one: pa.Table, i: int, two: pa.Table, j: int, keys: Sequence[str]) -> bool:
    return all(one.column(k)[i].as_py() == two.column(k)[j].as_py() for k in keys)
