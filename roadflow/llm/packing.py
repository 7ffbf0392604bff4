"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Every document becomes pieces of at most ``capacity`` tokens, of which only the first can be shorter. Full pieces are
sequences of their own. The others are dealt at random to groups of about ``group`` pieces, each packed by best-fit
decreasing. Dual-feasible functions bound from below how many sequences a group needs; a group that meets its bound is
certified and keeps its sequences but the emptiest. Groups with a gap keep what is full. What is left is exchanged:
dealt anew over fewer groups and packed again, until one group holds it or a round no longer shrinks it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import giving_back, in_small_batches, text_bytes
from roadflow.llm.arrays import pieces as text_pieces
from roadflow.llm.tokens import Encoder
from roadflow.session import staged

CAPACITY = 1024
GROUP = 50_000
END = 2


def tokenised(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 and a row number.

    A document's ids are the tokenizer's, then ``end``. Null and empty texts are the single id ``end``. Repeated rows
    are pieces of their own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(tokenizer)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in text_pieces(offsets):
                ids, begins = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield _cut(batch.column(0).slice(a, b - a), ids, begins)

    def _cut(keys, ids, begins) -> pa.RecordBatch:
        owner, number, start, length, crc = [], [], [], [], []
        for k in range(len(begins) - 1):
            own = np.append(ids[begins[k] : begins[k + 1]], np.uint32(end)).astype("<u4")
            at, n = 0, 0
            while at < len(own):
                size = (len(own) - at) % capacity or capacity
                owner.append(k), number.append(n), start.append(at), length.append(size)
                crc.append(zlib.crc32(own[at : at + size]))
                at, n = at + size, n + 1
        return pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(owner, pa.int64())),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(giving_back(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long").withColumn(
        "row", F.monotonically_increasing_id()
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by dual-feasible functions.

    For each threshold t up to half the capacity, lengths over capacity - t count as a whole sequence, those under t
    as nothing and the rest as they are; with t = 0 this is the total over the capacity.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    weight = np.concatenate([[0], np.cumsum(counts * np.arange(capacity + 1))])
    number = np.concatenate([[0], np.cumsum(counts)])
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t + 1]
    middle = weight[capacity - t + 1] - weight[t]
    return int((large + -(-middle // capacity)).max())


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some open sequence has room r
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = mask >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            where = open_by_room[left].pop()
            if not open_by_room[left]:
                mask ^= 1 << left
        else:
            where, left = len(room), capacity
            room.append(capacity)
        place[k], offset[k] = where, capacity - left
        left -= size
        room[where] = left
        if left:
            if not open_by_room[left]:
                mask |= 1 << left
            open_by_room[left].append(where)
    return place, offset, np.array(room, np.int64)


def _round(rows: DataFrame, groups: int, salt: int, last: bool, capacity: int) -> DataFrame:
    """Packs each group; ``sequence`` is null for the pieces that are exchanged."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        place, offset, room = best_fit_decreasing(lengths, capacity)
        certified = len(room) == lower_bound(lengths, capacity)
        kept = np.ones(len(room), bool) if certified or last else room == 0
        if certified and not last:
            kept[int(room.argmax())] = room.max() == 0
        group = int(table.column("group_id")[0].as_py())
        sequence = (place * groups + group) * 64 + salt
        out = {name: table.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32", "row")}
        out["sequence"] = pa.array(sequence, pa.int64(), mask=~kept[place])
        out["offset"] = pa.array(offset, pa.int64())
        out["certified"] = pa.array(np.full(len(lengths), certified), pa.bool_())
        return pa.table(out)

    dealt = rows.withColumn("group_id", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(groups)))
    return dealt.groupBy("group_id").applyInArrow(
        pack,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, row long, sequence long, offset long, "
        "certified boolean",
    )


def packed(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``tokenised`` pieces with sequence_id, offset and whether the group that packed them met its lower bound.

    ``group`` bounds the pieces that one task packs together. An empty table gives no rows.
    """
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.filter(F.col("length") == capacity).select(
        *keys, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")
    )
    rest, parts, salt = pieces.filter(F.col("length") < capacity), [full], 0
    left = rest.count()
    while left:
        groups = -(-left // group)
        last = groups == 1 or salt == 30
        done = staged(_round(rest, groups, salt, last, capacity), "packed")
        kept = done.filter("sequence is not null")
        parts.append(kept.select(*keys, (F.col("sequence") * 2).alias("sequence_id"), "offset", "certified"))
        rest = done.filter("sequence is null").select(*keys, "row")
        before, left, salt = left, rest.count(), salt + 1
        if left > 0.9 * before:  # exchanging no longer helps: pack what is left once more, for good
            done = staged(_round(rest, -(-left // group), salt, True, capacity), "packed")
            parts.append(done.select(*keys, (F.col("sequence") * 2).alias("sequence_id"), "offset", "certified"))
            left = 0
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def documents_packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Tokenises once, into a table in the shared folder, and packs."""
    return packed(staged(tokenised(docs, tokenizer, capacity), "pieces"), capacity, group)
