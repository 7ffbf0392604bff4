"""Places of long repeated windows in a corpus, exactly, without listing all windows.

A text is a sequence of units (bytes or words), a window so many consecutive units of one text. Of every window the
part of ``part`` units with the smallest hash is its anchor, so equal windows have equal anchors, and only a fraction
of all positions are anchors. A window's anchor and what may surround it within the window is the anchor's context.

1. Anchors with many contexts are counted first (``crowded``), as their hash alone does not split them.
2. Anchors are dealt to buckets by hash, crowded ones by that of their context (``occurrences``). Among those with equal
   contexts all windows are equal, which settles them. Anchors that are equal in different contexts may still share some
   windows.
3. For these alone, windows are hashed and dealt again (``compared``): by their anchor, or by the whole window where
   the anchor has many.

How entries are dealt does not change what is found: equal contexts and equal windows always meet.

Both exchanges carry packed arrays, and what a task can settle among its own texts is settled before it sends: of any
repeated context or window a task sends one occurrence, so a very frequent one does not fill a bucket.

Two rules say what is repeated: ``anywhere`` (the window starts at another place, the same text included) and
``earlier`` (it starts in a document with a smaller id).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import NOT_SPACE, Rolling, in_small_batches, mix, pieces, sliding_max, sliding_min, text_bytes, words
from roadflow.session import staged

SETTLED, OPEN, WIDE = 1, 2, 3  # WIDE: open, with so many windows that they are dealt one by one
WIDE_WINDOWS = 1 << 16
FEW, MANY = 1 << 16, 1 << 20  # entries of a bucket
LEAST_BUCKETS = 8
FLUSH = 1 << 20  # entries that a task gathers before it sends them
UNKNOWN_ID = 1 << 62
NONE = np.zeros(0, np.uint64)


@dataclass
class Units:
    """How texts are cut: ``window`` units, anchors of ``part`` units, pieces of ``piece`` bytes."""

    kind: str  # "bytes" or "words"
    window: int
    part: int
    rule: str  # "anywhere" or "earlier"
    piece: int = 1 << 19

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all units and the index of each text's first (one more at the end)."""
        if self.kind == "bytes":
            return data, offsets
        starts, ends, first = words(data, offsets, NOT_SPACE)
        return Rolling(data).spans(starts, ends), first

    @property
    def reach(self) -> int:
        """Units before an anchor that a window with it can hold."""
        return self.window - self.part


class Anchored:
    """Anchors of the windows of some texts."""

    def __init__(self, units: Units, data: np.ndarray, offsets: np.ndarray):
        codes, self.first = units.cut(data, offsets)
        self.units, self.rolling = units, Rolling(codes)
        n, size = len(codes), units.window
        self.parts = self.rolling.windows(units.part)
        width = units.reach + 1
        self.lowest = sliding_min(self.parts, width)
        whole = np.zeros(len(self.lowest), bool)
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= size:
                whole[a : b - size + 1] = True
        self.lowest = np.where(whole, self.lowest, np.uint64(0))
        if n < size:
            self.positions = self.same_before = np.zeros(0, np.int64)
            return
        padded = np.concatenate([np.zeros(width - 1, np.uint64), self.lowest, np.zeros(width - 1, np.uint64)])
        best = sliding_max(padded, width)
        self.positions = at = np.flatnonzero((self.parts == best[: len(self.parts)]) & (self.parts > 0))
        # For each anchor the last one before it with the same hash: of equal ones, a window has the first as its own.
        order = np.lexsort((at, self.parts[at]))
        self.same_before = np.full(len(at), -1)
        again = self.parts[at[order[1:]]] == self.parts[at[order[:-1]]]
        self.same_before[order[1:][again]] = at[order[:-1][again]]

    def texts(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def contexts(self) -> np.ndarray:
        at, text = self.positions, self.texts(self.positions)
        left = np.maximum(self.first[text], at - self.units.reach)
        right = np.minimum(self.first[text + 1], at + self.units.window)
        edges = (at - left).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(self.rolling.spans(left, right) + edges)

    def windows_of(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows that have these positions as anchors, and which position that is."""
        reach = self.units.reach
        starts = (positions[:, None] - np.arange(reach + 1)[None, :]).ravel()
        own = np.repeat(np.arange(len(positions)), reach + 1)
        good = (starts >= 0) & (starts < len(self.lowest))
        starts, own = starts[good], own[good]
        before = self.same_before[np.searchsorted(self.positions, positions)]
        good = (self.lowest[starts] == self.parts[positions[own]]) & (before[own] < starts)
        return starts[good], own[good]


def document_key(known: Column) -> Column:
    """The id as a number; for a null id a number above all ids, from the text."""
    unknown = F.lit(UNKNOWN_ID) + F.xxhash64("text").bitwiseAND(F.lit(UNKNOWN_ID - 1))
    return F.coalesce(known, unknown)


def keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id and text; ids that are no whole numbers are numbered in their own order, over the cluster."""
    rows = in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return rows.select(document_key(F.col("doc_id").cast("long")).alias("key"), "doc_id", "text")
    ids = rows.select("doc_id").dropna().distinct().repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    numbered = staged(ids.withColumn("number", F.monotonically_increasing_id()), "ids")
    return rows.join(numbered, "doc_id", "left").select(document_key(F.col("number")).alias("key"), "doc_id", "text")


_ENTRIES = "bucket int, kind int, base long, a binary, x binary, doc binary, pos binary"
_NAMES = ["bucket", "kind", "base", "a", "x", "doc", "pos"]


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, whether a row begins a new group."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def _settle(rule: str, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by group, document and place: which are repeats already, and which a group is sent by.

    ``earlier``: repeats are rows of any but the group's smallest document. ``anywhere``: all rows of a group of two.
    """
    start = np.flatnonzero(group)
    index = np.cumsum(group) - 1
    if rule == "earlier":
        least = doc[start][index]
        return doc > least, doc == least
    size = np.diff(np.append(start, len(group)))
    return size[index] > 1, group


def _by_both(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return a ^ mix(x + np.uint64(0x9E3779B97F4A7C15))


class _Sender:
    """Gathers entries (a, x, doc, pos, dealt) and packs them by bucket; a context of one task is sent once.

    ``dealt`` is what an entry's bucket follows from; it is the same for entries with equal a and x.
    """

    def __init__(self, rule: str, buckets: int):
        self.rule, self.buckets, self.held, self.count = rule, buckets, [], 0

    def add(self, a, x, doc, pos, dealt) -> Iterator[pa.RecordBatch]:
        self.held.append((a, x, doc, pos, dealt))
        self.count += len(a)
        if self.count >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        a, x, doc, pos, place = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.count = [], 0
        order = np.lexsort((pos, doc, x, a))
        a, x, doc, pos, place = a[order], x[order], doc[order], pos[order], place[order]
        repeat, sent = _settle(self.rule, _first_of(a, x), doc)
        # What is settled goes anywhere: it only has to reach the output once.
        for kind, chosen, dealt in ((SETTLED, repeat & ~sent, doc), (OPEN, sent, place)):
            # 'anywhere': the sent row of a settled group still has to meet the others, so it is marked as settled.
            known = repeat if self.rule == "anywhere" else np.zeros(len(a), bool)
            for mark in (False, True) if kind == OPEN else (False,):
                rows = np.flatnonzero(chosen & (known == mark)) if kind == OPEN else np.flatnonzero(chosen)
                if len(rows):
                    yield self._packed(kind + (2 if mark else 0), a[rows], x[rows], doc[rows], pos[rows], dealt[rows])

    def _packed(self, kind, a, x, doc, pos, dealt) -> pa.RecordBatch:
        bucket = (mix(dealt.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(self.buckets)).astype(np.int32)
        # By anchor and place: neighbours share what they can, which is what compression needs.
        order = np.lexsort((pos, doc, a, bucket))
        bucket = bucket[order]
        base = int(doc.min())
        offset = (doc - base)[order]
        offset = offset.astype(np.uint32) if offset.max() < 1 << 32 else offset.astype(np.uint64)
        start = np.flatnonzero(_first_of(bucket))
        stop = np.append(start[1:], len(bucket))
        # Windows of one anchor start next to each other: less their index, their places are constant.
        index = np.arange(len(bucket)) - np.repeat(start, stop - start)

        def blobs(values: np.ndarray) -> pa.Array:
            raw, width = values.tobytes(), values.dtype.itemsize
            return pa.array([raw[p * width : q * width] for p, q in zip(start, stop)], pa.binary())

        n = len(start)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[start], pa.int32()),
                pa.array(np.full(n, kind), pa.int32()),
                pa.array(np.full(n, base), pa.int64()),
                *map(blobs, (a[order], x[order], offset, (pos[order] - index).astype(np.int32))),
            ],
            _NAMES,
        )


Run = tuple[np.ndarray, ...]  # marked, a, x, doc, pos: by a; what is equal in a and x is settled


class Family:
    """Sorted runs of suffixes in levels of doubling size, as a logarithmic index.

    A new run is merged with the level of its size, as long as there is one. Merging puts equal contexts side by side:
    what is settled by that is given out at once, and the level keeps only what stands for its context.
    """

    def __init__(self, rule: str):
        self.rule, self.levels, self.settled = rule, {}, []

    def add(self, run: Run) -> None:
        while (level := len(run[0]).bit_length()) in self.levels:
            run = self._merge(self.levels.pop(level), run)
        if len(run[0]):
            self.levels[level] = run

    def all(self) -> Run:
        runs = [self.levels[k] for k in sorted(self.levels)]
        out = runs[0] if runs else tuple(np.zeros(0, t) for t in (bool, np.uint64, np.uint64, np.int64, np.int32))
        for run in runs[1:]:
            out = self._merge(out, run)
        return out

    def _merge(self, one: Run, two: Run) -> Run:
        marked, a, x, doc, pos = (np.concatenate(c) for c in zip(one, two))
        order = np.lexsort((pos, doc, x, a))
        marked, a, x, doc, pos = (v[order] for v in (marked, a, x, doc, pos))
        group = _first_of(a, x)
        repeat, stands = _settle(self.rule, group, doc)
        out = repeat & ~stands
        self.settled.append((doc[out], pos[out]))
        if self.rule == "anywhere":
            marked = np.logical_or.reduceat(marked | repeat, np.flatnonzero(group))[np.cumsum(group) - 1]
        return tuple(v[stands] for v in (marked, a, x, doc, pos))


def _runs(table: pa.Table) -> Iterator[tuple[int, Run]]:
    """Kind and entries of each packed row of a bucket."""
    for kind, base, a, x, doc, pos in zip(*(table.column(c).to_pylist() for c in _NAMES[1:])):
        n = len(pos) // 4
        offset = np.frombuffer(doc, np.uint32 if len(doc) == 4 * n else np.uint64).astype(np.int64)
        marked = np.full(n, kind == OPEN + 2)
        place = np.frombuffer(pos, np.int32) + np.arange(n, dtype=np.int32)
        yield (
            kind,
            (marked, np.frombuffer(a, np.uint64), np.frombuffer(x, np.uint64), base + offset, place),
        )


def _merged(rule: str, table: pa.Table, most: int, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, pos and kind of the entries of a bucket that are settled, or that have to be compared by windows.

    most: contexts that an anchor has without being WIDE; 0 if nothing is to be compared. many: crowded anchors, whose
    other contexts may be in other buckets.
    """
    family, out = Family(rule), []
    for kind, run in _runs(table):
        if kind == SETTLED:
            out.append((run[3], run[4]))
        else:
            family.add(run)
    marked, a, x, doc, pos = family.all()
    out += [*family.settled, (doc[marked], pos[marked])]
    doc_, pos_ = (np.concatenate(c) for c in zip(*out))
    found = [(doc_, pos_, np.full(len(doc_), SETTLED))]
    if most and len(a):
        order = np.lexsort((x, a))
        a, x, doc, pos = (v[order] for v in (a, x, doc, pos))
        begin = np.flatnonzero(_first_of(a))
        contexts = np.add.reduceat(_first_of(a, x).astype(np.int64), begin)
        contexts[np.isin(a[begin], many)] = most + 1
        contexts = np.repeat(contexts, np.diff(np.append(begin, len(a))))
        mixed = contexts > 1
        # What stands for a context stands for all that share it; settled ones may still match others in part.
        found.append((doc[mixed], pos[mixed], np.where(contexts[mixed] > most, WIDE, OPEN)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _exchange(entries: DataFrame, rule: str, most: int = 0, many: np.ndarray = NONE) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        doc, pos, kind = _merged(rule, table, most, many)
        return pa.table([pa.array(doc, pa.int64()), pa.array(pos, pa.int32()), pa.array(kind, pa.int32())], ["key", "pos", "kind"])

    return entries.groupBy("bucket").applyInArrow(merge, "key long, pos int, kind int")


def _buckets(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bucket_count(df: DataFrame, entries: int) -> int:
    """Buckets of ``FEW`` entries, or of up to ``MANY`` where the session's shuffle partitions would have more than four each.

    So packs do not shrink as shuffles get wider, and a bucket's memory has a bound.
    """
    return max(LEAST_BUCKETS, min(-(-entries // FEW), max(_buckets(df), -(-entries // MANY))))


def _anchored(batches: Iterator[pa.RecordBatch], units: Units) -> Iterator[tuple[np.ndarray, Anchored]]:
    for batch in batches:
        keys = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for i, j in pieces(offsets, units.piece):
            yield keys[i:j], Anchored(units, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def crowded(rows: DataFrame, units: Units) -> np.ndarray:
    return _contexts(rows, units)[0]


def _contexts(rows: DataFrame, units: Units) -> tuple[np.ndarray, int]:
    """Anchors, sorted, that have a large share of all contexts (one part in 32 shuffle partitions), and the number of contexts.

    Contexts are counted by lots of a task. A lot leaves out anchors with at most that share of its contexts, so no
    count lacks more than that share of all.
    """
    share = 8 * _buckets(rows)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate(held, axis=1)
        a, x = pairs[:, np.lexsort((pairs[1], pairs[0]))]
        a, n = np.unique(a[_first_of(a, x)], return_counts=True)
        total = int(n.sum())
        many = n * share > total
        hashes = [None, *a[many].view(np.int64).tolist()]
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array([total, *n[many].tolist()], pa.int64())], ["a", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for _, found in _anchored(batches, units):
            held.append(np.stack([found.parts[found.positions], found.contexts()]))
            count += len(found.positions)
            if count >= FLUSH:
                yield counted(held)
                held, count = [], 0
        if count:
            yield counted(held)

    lots = rows.select("key", "text").mapInArrow(run, "a long, n long")
    counts = staged(lots.groupBy("a").agg(F.sum("n").alias("n")), "anchor-counts")
    total = counts.filter("a is null").first()
    if total is None:
        return NONE, 0
    many = counts.filter(f"a is not null and n * {share} > {total['n']}").select("a").toPandas()
    return np.sort(many["a"].to_numpy(np.int64).view(np.uint64)), int(total["n"])


def occurrences(rows: DataFrame, units: Units) -> DataFrame:
    """key, pos, kind: anchors whose windows all repeat (SETTLED) and anchors to compare by windows (OPEN, WIDE)."""
    many, contexts = _contexts(rows, units)
    buckets = _bucket_count(rows, contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(units.rule, buckets)
        for keys, found in _anchored(batches, units):
            text = found.texts(found.positions)
            a, x = found.parts[found.positions], found.contexts()
            dealt = np.where(np.isin(a, many), _by_both(a, x), a)
            yield from sender.add(a, x, keys[text], found.positions - found.first[text], dealt)
        yield from sender.flush()

    most = max(1, WIDE_WINDOWS // (units.reach + 1))
    return _exchange(rows.select("key", "text").mapInArrow(run, _ENTRIES), units.rule, most, many)


def compared(rows: DataFrame, anchors: DataFrame, units: Units) -> DataFrame:
    """key, pos: starts of repeated windows around the OPEN and WIDE anchors."""
    left = anchors.filter(F.col("kind") != SETTLED).count()
    buckets = _bucket_count(rows, left * (units.reach + 1) // 2)  # an anchor is that of about half the windows it lies in

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(units.rule, buckets)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            places = batch.column(2)
            ends = np.asarray(places.offsets)
            flat = places.values.to_numpy()
            for i, j in pieces(offsets, units.piece):
                found = Anchored(units, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                own = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))
                at, wide = (flat[ends[i] : ends[j]] >> 1) + found.first[own], flat[ends[i] : ends[j]] & 1 == 1
                hashes = found.rolling.windows(units.window)
                for p in range(0, len(at), 4096):  # windows of some anchors at a time
                    start, which = found.windows_of(at[p : p + 4096])
                    text = own[p : p + 4096][which]
                    a, x = found.parts[at[p : p + 4096][which]], hashes[start]
                    dealt = np.where(wide[p : p + 4096][which], _by_both(a, x), a)
                    yield from sender.add(a, x, keys[i:j][text], start - found.first[text], dealt)
        yield from sender.flush()

    # A place and whether its windows are dealt one by one, as one number.
    place = F.col("pos").cast("long") * 2 + (F.col("kind") == WIDE).cast("long")
    todo = anchors.filter(F.col("kind") != SETTLED).groupBy("key").agg(F.sort_array(F.collect_set(place)).alias("places"))
    texts = rows.select("key", "text").join(todo, "key")
    return _exchange(texts.mapInArrow(run, _ENTRIES), units.rule)


def repeated_spans(docs: DataFrame, units: Units) -> DataFrame:
    """key, starts, ends: stretches of units (in any order, overlapping) that lie in repeated windows."""
    rows = keyed(docs)
    anchors = staged(occurrences(rows, units), "anchors")
    settled = anchors.filter(F.col("kind") == SETTLED).select(
        "key", (F.col("pos") - units.reach).alias("start"), (F.col("pos") + units.window).alias("end")
    )
    windows = compared(rows, anchors, units).select(
        "key", F.col("pos").alias("start"), (F.col("pos") + units.window).alias("end")
    )
    spans = settled.unionByName(windows)
    return spans.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def covered(first: np.ndarray, starts: pa.ListArray, ends: pa.ListArray) -> np.ndarray:
    """For each unit of some texts, whether a span of its text covers it."""
    edges = np.zeros(int(first[-1]) + 1, np.int64)
    at = np.asarray(starts.offsets)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    low, high = first[:-1][text], first[1:][text]
    begin = np.clip(starts.values.to_numpy()[at[0] : at[-1]] + low, low, high)
    stop = np.clip(ends.values.to_numpy()[at[0] : at[-1]] + low, low, high)
    np.add.at(edges, begin, 1)
    np.add.at(edges, stop, -1)
    return np.cumsum(edges[:-1]) > 0


def judged(docs: DataFrame, spans: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Every row of ``docs`` with its spans, through ``each`` (batches of key, doc_id, text, starts, ends)."""
    rows = keyed(docs).join(spans, "key", "left")
    none = F.expr("cast(array() as array<int>)")
    rows = rows.select(
        "key", "doc_id", "text", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column(2))
            for i, j in pieces(offsets):
                yield each(batch.slice(i, j - i))

    return rows.mapInArrow(run, schema)
