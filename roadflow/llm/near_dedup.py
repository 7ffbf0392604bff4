"""Near duplicates by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its five-word shingles (words: runs without white space, A-Z lower-cased; a text of fewer
words is one shingle). Two texts are linked when the weighted Jaccard similarity of their multisets, sum of smaller
counts over sum of larger counts, is 0.8 or more; the classes are the connected components.

Signature: the weights of a shingle are cut into the levels [0,1), [1,2), [2,4), [4,8) ... Each level of each shingle
has a Poisson process of its own with the level's length as rate; every point has a slot and, by repeated halving of the
level, a weight, and counts if the multiplicity reaches beyond it. A slot's value is its first point over all shingles,
so two texts agree in a slot with a probability equal to their weighted similarity. Processes advance in rounds, and
those already past every slot of their text stop.

Candidates: ``BANDS`` bands of ``ROWS`` slots; a pair at 0.8 shares no band with a probability of 1e-5. A bucket never
gives all its pairs. Its members are compared with its most central one (the one that shares most buckets with
others); then members whose classes still differ are compared with each other if their signatures say that they may be
similar enough. Every comparison that makes a link is exact, on the multisets of the two texts. Equal texts are one node throughout (by a 64-bit hash of the lower-cased text).
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadflow.llm import crowds
from roadflow.llm.arrays import LOWER, NOT_SPACE, Rolling, giving_back, in_small_batches, mix, pieces, ranges, shingles, text_bytes, words
from roadflow.session import staged

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 48, 7
BLOCK = 256
SLACK = 0.08
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the index of each text's first (one more at the end)."""
    starts, ends, first = words(data, offsets, NOT_SPACE)
    hashes = Rolling(LOWER[data]).spans(starts, ends)
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(begin[-1], np.uint64)
    long = counts >= size
    all_ = shingles(hashes, size)
    out[ranges(begin[:-1][long], n[long])] = all_[ranges(first[:-1][long], n[long])]
    for k in np.flatnonzero((counts > 0) & ~long):
        out[begin[k]] = mix(shingles(hashes[first[k] : first[k + 1]], int(counts[k])) + np.uint64(counts[k]))[0]
    return out, begin


def counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of the distinct shingles of each text, by text and hash."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def bag_minhash(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n_texts: int, slots: int) -> np.ndarray:
    """First points of every text and slot (texts x slots), as exact integers; ``_NEVER`` for texts without shingles."""
    depth = np.zeros(len(counts), np.int64)
    depth[counts > 1] = np.ceil(np.log2(counts[counts > 1])).astype(np.int64)
    own = np.repeat(np.arange(len(counts)), depth + 1)
    level = ranges(np.zeros(len(counts), np.int64), depth + 1)
    lowest = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.where(level > 0, lowest, 1.0)
    text, weight = text[own], counts[own].astype(float)
    seed = mix(hashes[own] + level.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    reached = np.zeros(len(own), np.uint64)
    drawn = np.zeros(len(own), np.uint64)
    table = np.full(n_texts * slots, _NEVER, np.uint64)
    while len(own):
        # About two points a slot for each text and round, one a process at least.
        share = np.maximum(1, 2 * slots // np.maximum(1, np.bincount(text, minlength=n_texts)))[text]
        which = np.repeat(np.arange(len(own)), share)
        step = drawn[which] + ranges(np.zeros(len(own), np.int64), share).astype(np.uint64)
        draw = mix(seed[which] + (step + np.uint64(1)) * _STEP)
        gap = -np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53) / length[which]
        ticks = (gap * 2.0**32).astype(np.uint64) + np.uint64(1)
        sums = np.cumsum(ticks, dtype=np.uint64)
        last = np.cumsum(share) - 1
        before = np.concatenate([[np.uint64(0)], sums[last[:-1]]]).astype(np.uint64)
        point = reached[which] + sums - before[which]
        place = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        slot = ((place >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        height = lowest[which] + (place & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 * length[which]
        counts_ = height < weight[which]
        np.minimum.at(table, (text[which] * slots + slot.astype(np.int64))[counts_], point[counts_])
        reached, drawn = point[last], drawn + share.astype(np.uint64)
        still = reached < table.reshape(n_texts, slots).max(axis=1)[text]
        own, text, weight, seed, reached, drawn, lowest, length = (
            x[still] for x in (own, text, weight, seed, reached, drawn, lowest, length)
        )
    return table.reshape(n_texts, slots)


def node(text: Column) -> Column:
    """Equal up to the case of A-Z: the same node."""
    return F.xxhash64(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase))


def _table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its first points (by band and row), the hashes of its bands and its number of shingles."""
    found, first = text_shingles(data, offsets)
    n = len(offsets) - 1
    table = bag_minhash(*counted(found, first), n, BANDS * ROWS).reshape(n, BANDS, ROWS)
    hashes = np.zeros((n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        hashes = mix((hashes ^ table[:, :, k]) * _STEP + np.uint64(k))
    return table, hashes, np.diff(first)


def _signed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, node, row, size (number of shingles) and the hashes of its bands (none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in pieces(offsets):
                _, hashes, sizes = _table(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(hashes[sizes > 0].ravel().view(np.int64))),
                    ],
                    ["doc_id", "node", "size", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    return (
        in_small_batches(docs)
        .select("doc_id", node(F.col("text")).alias("node"), text.alias("text"))
        .mapInArrow(giving_back(run), f"doc_id {kind}, node long, size long, bands array<long>")
        .withColumn("row", F.monotonically_increasing_id())
    )


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle multisets of two columns of texts (0 if both are without words)."""
    out = np.zeros(len(left))
    (a_data, a_at), (b_data, b_at) = text_bytes(left), text_bytes(right)
    for a, b in pieces(a_at + b_at):
        both = []
        for data, at in ((a_data, a_at), (b_data, b_at)):
            both.append(counted(*text_shingles(data[at[a] : at[b]], at[a : b + 1] - at[a])))
        text, found, count = (np.concatenate([x, y]) for x, y in zip(*both))
        order = np.lexsort((found, text))
        text, found, count = text[order], found[order], count[order]
        same = np.flatnonzero((text[1:] == text[:-1]) & (found[1:] == found[:-1]))
        common = np.bincount(text[same], np.minimum(count[same], count[same + 1]), b - a)
        total = np.bincount(text, count, b - a) - common
        out[a:b] = common / np.maximum(total, 1)
    return out


def _sketches(texts: DataFrame) -> DataFrame:
    """node and sketch: its band hashes, then a byte of every slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                table, hashes, _ = _table(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                low = (mix(table.reshape(b - a, -1)) & np.uint64(255)).astype(np.uint8)
                rows = np.concatenate([hashes.view(np.uint8).reshape(b - a, -1), low], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([r.tobytes() for r in rows], pa.binary())], ["node", "sketch"]
                )

    return texts.select("node", "text").mapInArrow(giving_back(run), "node long, sketch binary")


def _likely(least: float):
    """Of a meeting the pairs of nodes whose sketches agree in enough slots, each in its first common band only."""

    def found(group: pa.Table) -> pa.RecordBatch | None:
        bucket = group.column("bucket")[0].as_py()
        home, large, nodes, label, size = (group.column(c).to_numpy() for c in ("home", "large", "node", "label", "size"))
        raw = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(nodes), -1)
        bands, slots = np.ascontiguousarray(raw[:, : BANDS * 8]).view(np.int64), raw[:, BANDS * 8 :]
        one, two, fit = crowds.partners(home, large, nodes, label)
        fit &= np.minimum(size[one][:, None], size[two]) >= (least + SLACK) * np.maximum(size[one][:, None], size[two])
        # A third of the slots first: at the similarity sought, this test fails by chance once in a hundred million.
        part = slots.shape[1] // 3
        x, y = np.nonzero(fit)
        for begin, end, wanted in ((0, part, least - 0.13), (0, slots.shape[1], least)):
            keep = np.zeros(len(x), bool)
            for k in range(0, len(x), 1 << 15):
                i, j = one[x[k : k + (1 << 15)]], two[y[k : k + (1 << 15)]]
                keep[k : k + (1 << 15)] = (slots[i, begin:end] == slots[j, begin:end]).mean(axis=1) >= wanted
            x, y = x[keep], y[keep]
        i, j = one[x], two[y]
        if not len(i):
            return None
        common = (bands[i] == bands[j]).argmax(axis=1)
        here = bands[i, common] == bucket
        p, q = nodes[i[here]], nodes[j[here]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])

    return found


def _across_classes(placed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of members of a bucket that are in different classes and likely to be similar enough.

    Members meet as ``crowds`` deals them: those of a bucket's largest class stay where they are. What does not agree in
    ``similarity - SLACK`` of the slots is not given out: 336 slots estimate 0.8 with a deviation of 0.022.
    """
    met = crowds.meetings(placed, BLOCK)
    sketches = staged(_sketches(texts.join(met.select("node").distinct(), "node")), "sketches")
    rows = met.join(sketches, "node")
    return crowds.scanned(rows, ["bucket", "block", "chunk"], _likely(similarity - SLACK), "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b) of nodes those whose texts are similar enough; ``texts``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = pa.array(similarities(batch.column(2), batch.column(3)) >= similarity)
            yield batch.select(["a", "b"]).filter(good)

    one, two = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(giving_back(run), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it is connected with) of all nodes with a link.

    Every round takes the smallest label among the neighbours, then the label of that label, so the rounds needed grow
    with the logarithm of a component's extent.
    """
    both = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels"
    )
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        lower = labels.join(around, labels["node"] == around["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        lower = staged(lower, "labels")
        over = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = staged(
            lower.join(over, "label", "left").select("node", "old", F.coalesce("further", "label").alias("label")), "labels"
        )
        if labels.filter("label != old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, node, class_id (smallest doc_id of the class), class_size, n_links and kept.

    ``n_links`` counts the different texts that a document's text was found similar to. The row with the smallest
    doc_id of a class is kept (null is the largest; of repeated rows one). Equal texts are in one class, also texts
    without words, which have no other links. Other columns are not read; an empty table gives no rows.
    """
    signed = staged(_signed(docs), "signatures")
    # One row a node: its texts are equal but for case, and so are their signatures.
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    nodes = staged(nodes, "nodes")
    links = _links(nodes, docs, similarity)
    labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    labelled = (
        signed.select("doc_id", "node", "row")
        .join(labels, "node", "left")
        .join(degree, "node", "left")
        .select(
            "doc_id", "node", "row", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        )
    )
    labelled = staged(labelled, "labelled")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = labelled.groupBy("label").agg(best.alias("best"), F.count(F.lit(1)).alias("class_size"))
    return labelled.join(groups, "label").select(
        "doc_id",
        "node",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        "n_links",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def _links(nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Verified links (a, b), a < b, between different texts."""
    in_bands = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    crowded = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(in_bands.join(crowded, "bucket"), "members")
    central = members.groupBy("node").agg(F.sum("n").alias("score"))
    leaders = (
        members.join(central, "node").groupBy("bucket").agg(F.max(F.struct("score", "node", "size")).alias("leader"))
    )
    near = F.least("size", "other") >= similarity * F.greatest("size", "other")  # else they cannot be similar enough
    spokes = (
        members.join(leaders, "bucket")
        .select("node", "size", F.col("leader.node").alias("leader"), F.col("leader.size").alias("other"))
        .filter(F.col("node") != F.col("leader"))
        .filter(near)
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        .distinct()
    )
    spokes = staged(spokes, "spokes")
    wanted = members.select("node").distinct()
    texts = (
        docs.select("doc_id", node(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
        .alias("t")
        .join(
            nodes.join(wanted, "node").select("node", "doc_id").alias("n"),
            (F.col("t.node") == F.col("n.node")) & F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")),
        )
        .select("t.node", "t.text")
        .dropDuplicates(["node"])  # rows that repeat their id and text
    )
    texts = staged(texts, "texts")
    first = staged(verified(spokes, texts, similarity), "links")
    labels = components(first)
    placed = members.join(labels, "node", "left").select(
        "bucket", "node", "size", F.coalesce("label", "node").alias("label")
    )
    rest = _across_classes(staged(placed, "placed"), texts, similarity).join(spokes, ["a", "b"], "left_anti")
    second = verified(rest, texts, similarity)
    return staged(first.unionByName(second).distinct(), "links")


def without_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of every class, that with the smallest doc_id; all columns stay."""
    kept = classes(docs, similarity).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"))
    kept = staged(kept, "kept")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), node(F.col("text")).alias("node"))
    same = (F.col("node") == F.col("kept_node")) & F.col("doc.doc_id").eqNullSafe(F.col("kept_id"))
    found = rows.join(kept, same, "left_semi")
    order = Window.partitionBy("node", "doc.doc_id").orderBy("node")
    return found.withColumn("place", F.row_number().over(order)).filter("place = 1").select("doc.*")
