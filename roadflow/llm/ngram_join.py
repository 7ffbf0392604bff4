"""N-gram Jaccard join: documents whose sets of five-word shingles are alike, by a size-aware heavy-light join.

A document's set holds its distinct shingles (A-Z lower-cased; a text of fewer words is one shingle). Two documents are linked
when 100 * common >= 80 * all. Shingles have one order for all sets: rare before frequent, by a counting sketch of fixed
size, then by hash. Sets that may be linked have a least overlap that follows from their sizes, so k of their common shingles
stand among the first of both (the set's size less the least overlap, plus k).

Small sets enumerate all pairs (k = 2) of their first shingles as keys; large sets scan the inverted lists of single first
shingles (k = 1), in which small sets that could match a large one are listed too. The boundary is that of least
cost: rows of enumerated pairs against rows of lists and what scanning them meets, from the sizes and the sketch.

What shares a key is a candidate. A key that many sets share never gives all its pairs: members are first verified
against the key's smallest node, then only members that are still in different components meet (``crowds``), and a
parity bitmap of each set, whose differing bits are a lower bound of the sets' difference, drops pairs that cannot be linked.
Every link is verified on the texts, and no pair that could link two components is left out, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflow.llm import crowds
from roadflow.llm.arrays import LOWER, NOT_SPACE, giving_back, in_small_batches, mix, pieces, ranges, shingles, span_hashes, text_bytes, words
from roadflow.llm.near_dedup import components
from roadflow.session import staged

WORDS = 5
PERCENT = 80
COUNTERS = 1 << 20  # of the sketch: 4 MB a task, 1 MB for the classes that every task gets
SLICES = 64
TOKEN = np.uint64((1 << 58) - 1)
CLASS_SHIFT = np.uint64(58)
BOUNDARIES = [3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128]  # sets up to this size are small
FIRST = 32  # buckets by which a pair that meets in several is recognised
LEAST_SIZE = 4  # smaller sets are linked with equal ones only


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """58-bit hashes of each text's shingles, not yet distinct, and the text of each."""
    starts, ends, first = words(data, offsets, NOT_SPACE)
    hashes = span_hashes(LOWER[data], starts, ends)
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(begin[-1], np.uint64)
    long = counts >= size
    out[ranges(begin[:-1][long], n[long])] = shingles(hashes, size)[ranges(first[:-1][long], n[long])]
    for k in np.flatnonzero((counts > 0) & ~long):
        out[begin[k]] = mix(shingles(hashes[first[k] : first[k + 1]], int(counts[k])) + np.uint64(counts[k]))[0]
    return out & TOKEN, np.repeat(np.arange(len(counts)), n)


def distinct(tokens: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of every text, one text after the other, and where each text's begin."""
    if (text[1:] < text[:-1]).any():
        order = np.argsort(text, kind="stable")
        tokens, text = tokens[order], text[order]
    tokens, edges = tokens.copy(), np.searchsorted(text, np.arange(n_texts + 1)).tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        tokens[a:b].sort()  # text by text: several times faster than one sort by text and token
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (tokens[1:] != tokens[:-1])
    return tokens[new], np.searchsorted(text[new], np.arange(n_texts + 1))


def nodes_of(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set, from its tokens without their class."""
    out = np.zeros(len(first) - 1, np.int64)
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        out[k] = int.from_bytes(hashlib.blake2b(tokens[a:b].tobytes(), digest_size=8).digest(), "little", signed=True)
    return out


def least_overlap(size, percent: int = PERCENT):
    """Of a set of ``size`` with any set it may be linked with; for numbers and arrays."""
    other = -(-percent * size // 100)
    return -(-percent * (size + other) // (100 + percent))


def _read(docs: DataFrame, counters: int) -> DataFrame:
    """One reading of the texts: doc_id, node and size of every row, and each task's sketch in rows of slice and counts."""
    slices = min(SLICES, counters)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, ids = np.zeros(counters, np.int64), None
        for batch in batches:
            ids = batch.column(0).type
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                tokens, first = distinct(*shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), b - a)
                total += np.bincount((tokens % np.uint64(counters)).astype(np.int64), minlength=counters)
                none = [pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.binary())]
                columns = [batch.column(0).slice(a, b - a), pa.array(nodes_of(tokens, first)), pa.array(np.diff(first)), *none]
                yield pa.RecordBatch.from_arrays(columns, names)
        if total.any():
            none = [pa.nulls(slices, ids), pa.nulls(slices, pa.int64()), pa.nulls(slices, pa.int64())]
            counts = [r.tobytes() for r in total.astype(np.uint32).reshape(slices, -1)]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(slices), pa.int32()), pa.array(counts, pa.binary())], names)

    names = ["doc_id", "node", "size", "slice", "counts"]
    rows = in_small_batches(docs).select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(giving_back(run), f"doc_id {kind.simpleString()}, node long, size long, slice int, counts binary")


def _sketch(read: DataFrame, counters: int) -> tuple[bytes, float]:
    """Frequency class of every counter (0 for what is not clearly frequent), and the mean number of further sets that a
    set meets in a list of class 0."""
    wide = counters // min(SLICES, counters)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(wide, np.int64)
        for raw in group.column("counts"):
            total += np.frombuffer(raw.as_buffer(), np.uint32)
        return pa.table({"slice": group.column("slice").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    added = read.filter("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, counts binary")
    found = np.zeros(counters, np.int64)
    for row in added.collect():  # SLICES rows, eight bytes a counter, whatever the input
        found[row["slice"] * wide : (row["slice"] + 1) * wide] = np.frombuffer(row["counts"], np.int64)
    limit = int(4 * found.mean() + 16)
    classes = np.where(found > limit, np.floor(np.log2(np.maximum(found, 1))), 0).astype(np.uint8)
    usual = found[found <= limit].astype(float)
    beyond = float((usual**2).sum() / max(usual.sum(), 1.0) - usual.mean() - 1) if len(usual) else 0.0
    return classes.tobytes(), max(0.0, beyond)


def boundary(sets: DataFrame, beyond: float, percent: int = PERCENT) -> int:
    """The size up to which sets are small: where rows of enumerated pairs, rows of lists and rows met in them are fewest."""
    size = F.col("size")
    other = F.ceil(size * percent / 100)
    overlap = F.ceil((size + other) * percent / (100 + percent))
    single, double = size - overlap + 1, size - overlap + 2
    costs = []
    for limit in BOUNDARIES:
        pairs = F.when((size <= limit) & (size >= LEAST_SIZE), double * (double - 1) / 2).otherwise(0.0)
        lists = F.when((size * 100 >= limit * percent) & (size >= LEAST_SIZE), single * (1.0 + beyond)).otherwise(0.0)
        costs.append(F.sum(pairs + lists).alias(str(limit)))
    row = sets.agg(*costs).first()
    return min(BOUNDARIES, key=lambda limit: (row[str(limit)] or 0.0, limit))


def _postings(docs: DataFrame, classes: bytes, limit: int, percent: int) -> DataFrame:
    """key, node, size, large and hot: the keys of every set of at least ``LEAST_SIZE``, once a task.

    A key of an inverted list is a shingle; ``large`` says that the set scans it. A key of a pair has the lowest bit set, and all
    its sets count as large. ``hot`` keys are of frequent shingles only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.frombuffer(classes, np.uint8), set()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in pieces(offsets):
                tokens, text = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                tokens, first = distinct(tokens, text, b - a)
                node, size = nodes_of(tokens, first), np.diff(first)
                fresh = np.array([s >= LEAST_SIZE and not (x in seen or seen.add(x)) for x, s in zip(node.tolist(), size.tolist())], bool)
                kind = table[(tokens % np.uint64(len(table))).astype(np.int64)].astype(np.uint64)
                ordered, _ = distinct(tokens | (kind << CLASS_SHIFT), np.repeat(np.arange(b - a), size), b - a)
                spare = size - least_overlap(size, percent)
                listed = fresh & (size * 100 >= (limit + 1) * percent)
                rows = [_listed(ordered, first, spare + 1, np.flatnonzero(listed))]
                small = np.flatnonzero(fresh & (size <= limit))
                for k in np.unique(spare[small]).tolist():
                    rows.append(_paired(ordered, first, k + 2, small[spare[small] == k]))
                key, own, hot = (np.concatenate(c) for c in zip(*rows))
                of_pair = (key & np.uint64(1)) == 1
                columns = [key.view(np.int64), node[own], size[own].astype(np.int32), of_pair | (size[own] > limit), hot]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "node", "size", "large", "hot"])

    schema = "key long, node long, size int, large boolean, hot boolean"
    return in_small_batches(docs).select(F.col("text").cast("string")).mapInArrow(giving_back(run), schema)


def _listed(tokens, first, length, which):
    """The first ``length`` tokens of the sets ``which``, as keys."""
    at = ranges(first[:-1][which], length[which])
    return tokens[at] << np.uint64(1), np.repeat(which, length[which]), (tokens[at] >> CLASS_SHIFT) > 0


def _paired(tokens, first, length: int, which):
    """All pairs of the first ``length`` tokens of the sets ``which``, as keys."""
    rows = tokens[first[:-1][which][:, None] + np.arange(length)]
    one, two = np.array(list(combinations(range(length), 2))).T
    key = mix(mix(rows[:, one]) + rows[:, two]) | np.uint64(1)
    hot = (rows[:, one] >> CLASS_SHIFT) > 0  # the rarer of the two
    return key.ravel(), np.repeat(which, len(one)), hot.ravel()


def _members(postings: DataFrame) -> DataFrame:
    """key, node, size and leader (its smallest node) of the keys that different sets share, one of them large.

    Lists of frequent shingles may be of any length: they are counted before the shuffle and joined back. The rest are
    as short as the sketch says and are scanned after one shuffle.
    """
    cold = Window.partitionBy("key")
    low, high, large = F.min("node"), F.max("node"), F.max("large")
    first = F.min(F.struct("node", "size"))
    scanned = postings.filter("NOT hot").withColumns(
        {"low": low.over(cold), "high": high.over(cold), "any": large.over(cold), "leader": first.over(cold)}
    )
    hot = postings.filter("hot").distinct()
    shared = hot.groupBy("key").agg(low.alias("low"), high.alias("high"), large.alias("any"), first.alias("leader"))
    joined = hot.join(shared.filter("low < high AND any"), "key")
    columns = ["key", "node", "size", "leader"]
    return scanned.filter("low < high AND any").select(*columns).distinct().unionByName(joined.select(*columns))


def _once(members: DataFrame) -> DataFrame:
    """``members`` without the keys that hold the same sets as another key: two long copies share thousands of them."""
    mixed = F.xxhash64("node")
    same = [F.sum(F.shiftrightunsigned(mixed, 20)).alias("sum"), F.bit_xor(mixed).alias("xor"), F.count(F.lit(1)).alias("n")]
    kept = members.groupBy("key").agg(*same).groupBy("sum", "xor", "n").agg(F.min("key").alias("key")).select("key")
    return members.join(kept, "key", "left_semi")


def parity(tokens: np.ndarray, size: int) -> bytes:
    """A bit for each token's remainder, set if an odd number of tokens has it; about as many bits as tokens."""
    bits = 64
    while bits < size:
        bits *= 2
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _bitmaps(texts: DataFrame) -> DataFrame:
    """node and bitmap of ``texts`` (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                tokens, first = distinct(*shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), b - a)
                maps = [parity(tokens[p:q], q - p) for p, q in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(maps, pa.binary())], ["node", "bitmap"])

    return texts.mapInArrow(giving_back(run), "node long, bitmap binary")


def _possible(percent: int):
    """Pairs of a meeting whose sizes and bitmaps allow a link."""

    def found(group: pa.Table) -> pa.RecordBatch | None:
        home, large, node, label, size = (group.column(c).to_numpy() for c in ("home", "large", "node", "label", "size"))
        one, two, fit = crowds.partners(home, large, node, label)
        s, t = size[one].astype(np.int64)[:, None], size[two].astype(np.int64)[None, :]
        fit &= np.minimum(s, t) * 100 >= np.maximum(s, t) * percent
        x, y = np.nonzero(fit)
        if not len(x):
            return None
        x, y = one[x], two[y]
        maps = [np.frombuffer(b.as_buffer(), np.uint64) for b in group.column("bitmap").combine_chunks()]
        width = np.array([len(m) for m in maps])
        kept = np.zeros(len(x), bool)
        for wide in np.unique(np.minimum(width[x], width[y])).tolist():
            rows = np.flatnonzero(width >= wide)
            place = np.zeros(len(maps), np.int64)
            place[rows] = np.arange(len(rows))
            folded = np.array([np.bitwise_xor.reduce(maps[r].reshape(-1, wide), axis=0) for r in rows])
            here = np.flatnonzero(np.minimum(width[x], width[y]) == wide)
            for at in range(0, len(here), 4096):
                part = here[at : at + 4096]
                differ = np.bitwise_count(folded[place[x[part]]] ^ folded[place[y[part]]]).sum(axis=1, dtype=np.int64)
                both = size[x[part]].astype(np.int64) + size[y[part]]
                kept[part] = differ * (100 + percent) <= both * (100 - percent)
        x, y = x[kept], y[kept]
        here = _met_here(group, x, y)
        a, b = node[x[here]], node[y[here]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return found


def _met_here(group: pa.Table, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether this bucket is the first that both of a pair list among their ``FIRST`` first buckets, or they list none."""
    mine = group.column("bucket")[0].as_py()
    lists = group.column("buckets").combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    table = np.full((len(counts), FIRST), np.iinfo(np.int64).max)
    table[np.repeat(np.arange(len(counts)), counts), ranges(np.zeros(len(counts), np.int64), counts)] = lists.flatten().to_numpy()
    out = np.zeros(len(x), bool)
    for at in range(0, len(x), 2048):
        one, two = table[x[at : at + 2048]], table[y[at : at + 2048]]
        both = (one[:, :, None] == two[:, None, :]).any(axis=2)
        first = np.where(both, one, np.iinfo(np.int64).max).min(axis=1)
        out[at : at + 2048] = (first == mine) | (first == np.iinfo(np.int64).max)
    return out


def linked(left: pa.Array, right: pa.Array, percent: int = PERCENT) -> np.ndarray:
    """Whether the sets of two columns of texts are alike enough."""
    out = np.zeros(len(left), bool)
    (a_data, a_at), (b_data, b_at) = text_bytes(left), text_bytes(right)
    for a, b in pieces(a_at + b_at):
        sides = []
        for data, at in ((a_data, a_at), (b_data, b_at)):
            tokens, first = distinct(*shingle_sets(data[at[a] : at[b]], at[a : b + 1] - at[a]), b - a)
            sides.append((tokens, np.repeat(np.arange(b - a), np.diff(first))))
        tokens, text = (np.concatenate(c) for c in zip(*sides))
        every, first = distinct(tokens, text, b - a)
        union = np.diff(first)
        common = np.bincount(text, minlength=b - a) - union
        out[a:b] = (union > 0) & (100 * common >= percent * union)
    return out


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes those that are linked; ``texts``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(linked(batch.column(2), batch.column(3), percent)))

    one, two = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(giving_back(run), "a long, b long")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text, one text for each of the nodes ``wanted`` (node, doc_id: a document that has the set).

    Documents may share an id, so what is found by id is compared with the node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                tokens, first = distinct(*shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), b - a)
                same = nodes_of(tokens, first) == batch.column(0).slice(a, b - a).to_numpy()
                yield batch.slice(a, b - a).filter(pa.array(same))

    texts = docs.filter("text IS NOT NULL").select("doc_id", F.col("text").cast("string")).alias("t")
    found = texts.join(wanted.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))).select("node", "text")
    return found.mapInArrow(giving_back(run), "node long, text string").dropDuplicates(["node"])


def _links(docs: DataFrame, sets: DataFrame, firsts: DataFrame, sketch: tuple[bytes, float], percent: int) -> DataFrame:
    """Verified links (a, b) between different sets that connect all that are connected."""
    classes, beyond = sketch
    limit = boundary(sets, beyond, percent)
    members = staged(_members(_postings(docs, classes, limit, percent)), "members")
    members = staged(_once(members), "members")
    wanted = firsts.join(members.select("node").distinct(), "node").select("node", F.col("first").alias("doc_id"))
    texts = staged(_texts_of(docs, wanted), "texts")
    alike = F.least("size", "leader.size") * 100 >= F.greatest("size", "leader.size") * percent
    spokes = (
        members.filter(F.col("node") != F.col("leader.node"))
        .filter(alike)
        .select(F.col("leader.node").alias("a"), F.col("node").alias("b"))  # the leader is the smallest node
        .distinct()
    )
    spokes = staged(spokes, "spokes")
    first = staged(verified(spokes, texts, percent), "links")
    labels = components(first)
    placed = members.join(labels, "node", "left").select(
        F.col("key").alias("bucket"), "node", "size", F.coalesce("label", "node").alias("label")
    )
    met = crowds.meetings(staged(placed, "placed"))
    of_node = met.select("node", "bucket").distinct().withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("bucket")))
    of_node = of_node.filter(F.col("place") <= FIRST).groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    met = met.join(staged(of_node.join(_bitmaps(texts), "node"), "bitmaps"), "node")
    rest = crowds.scanned(met, ["bucket", "block", "chunk"], _possible(percent), "a long, b long").distinct()
    second = verified(rest.join(spokes, ["a", "b"], "left_anti"), texts, percent)
    return staged(first.unionByName(second), "links")


def joined(docs: DataFrame, percent: int = PERCENT, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id it is connected with.

    Documents without words (and null texts) are connected with nothing, not even with each other. A null doc_id is the
    largest; repeated rows have equal sets and so one component. Other columns are not read; an empty table gives no rows.
    """
    read = staged(_read(docs, counters), "sets")
    sets = read.filter("slice IS NULL").select("doc_id", "node", "size")
    firsts = staged(sets.filter("size > 0").groupBy("node").agg(F.min("doc_id").alias("first")), "firsts")
    labels = components(_links(docs, sets, firsts, _sketch(read, counters), percent))
    named = firsts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = staged(named, "named")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    found = named.join(smallest, "label").select("node", "component_id", F.lit(True).alias("found"))
    return sets.join(found, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
