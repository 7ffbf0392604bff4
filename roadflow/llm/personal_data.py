"""Personal data in whole texts: fixed forms first, then identifiers found by their context.

Base spans are e-mail and IP addresses, card numbers and telephone numbers, by pattern. They seed a bootstrap. Lexical
patterns are the one to three words before a span, those after it and both together, each with the punctuation between
(white space as one space, A-Z lower-cased), and a word with a separator (``name:``, ``token = "``); what stands there
is the instance. Spark scores the graph of patterns and instances over several rounds: a pattern is as good as the share
of its occurrences that are seeds or good instances, an instance with the shape of an identifier as good as the best
pattern of high confidence and support that it occurs with. Such patterns then give spans of the kind ``id``.

Occurrences that are neither seeds nor shaped count against a pattern. They are counted in a second reading of the texts,
only for patterns that are good without them, and part by part for those that the parts before have not refuted; a bit table
narrows them before the shuffle, the join decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import LOWER, NOT_SPACE, Rolling, in_small_batches, mix, pieces, text_bytes, words
from roadflow.session import staged

KINDS = ["email", "ip", "card", "phone"]
FOUND = "id"
ROUNDS = 3
CONFIDENCE = 0.75
SUPPORT = 2
REACH = 3  # words of a pattern on a side
MOST_BITS = 27  # of the bit table of patterns: 16 MB
# Documents are counted against patterns in parts that grow by four, up to these of 64 shares; the last is the whole.
PARTS = [1, 4, 16, 64]
# What names a secret or an identifier. Its pattern starts as good, as by one seed more than it has; the
# rounds and SUPPORT may revise that.
CUES = {"token", "password", "passwd", "pwd", "secret", "key", "apikey", "api_key", "ssn", "passport", "iban", "account"}

# Runs are entered at their first character only and never given back, so that no text takes quadratic time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERED = re.compile(r"[0-9]")
# A lexical pattern: a word, a separator and perhaps a quote, right before a token.
_SEPARATOR = re.compile(r"[:=#]")
_PATTERN_END = re.compile(r"([A-Za-z_]{2,30})(\s{0,2}[:=#]\s{0,2}[\"']?)$")
_WORD_END = re.compile(r"[A-Za-z_]{2,30}\s{0,2}$")
_AFTER = re.compile(r"\s{0,2}[\"']?(?=[A-Za-z0-9_-])")
_TOKEN = re.compile(r"[A-Za-z0-9_-]++")
LEAST_LENGTH = 6


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ is reached by the run of local characters before it, from the end of the last match on."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                last = domain.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    if _NUMBERED.search(text):
        found += [
            ("ip", m.start(), m.end())
            for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        ]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def _pattern(text: str, at: int) -> str | None:
    """The lexical pattern that ends at a position: word, separator and quote, with white space as single spaces."""
    found = _PATTERN_END.search(text, max(0, at - 37), at)
    return re.sub(r"\s+", " ", found[0]).lower() if found else None


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str, str, bool]]:
    """(start, end, pattern, instance, shaped) of the tokens after a lexical pattern, outside base spans.

    Shaped like an identifier is a token with a digit and ``LEAST_LENGTH`` characters; the others count against their
    pattern.
    """
    taken = sorted((a, b) for _, a, b in base)
    out, k = [], 0
    for m in _SEPARATOR.finditer(text):
        after = _AFTER.match(text, m.end())
        if not after or not _WORD_END.search(text, max(0, m.start() - 32), m.start()):
            continue
        token = _TOKEN.match(text, after.end())
        start, end = token.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        pattern = _pattern(text, start)
        if pattern and not (k < len(taken) and taken[k][0] < end):
            shaped = end - start >= LEAST_LENGTH and _NUMBERED.search(token[0]) is not None
            out.append((start, end, pattern, token[0] if shaped else "", shaped))
    return out


def _contexts(text: str, base) -> list[tuple[str, str]]:
    found = ((_pattern(text, a), text[a:b]) for _, a, b in base)
    return [(p, i) for p, i in found if p]


def _inside() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(65, 91), *range(97, 123), ord("_"), ord("-")]] = True
    inside[128:] = True
    return inside


_INSIDE = _inside()
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) < 58)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Surroundings:
    """Words and base spans of some texts as units in their order, and the hashes of what surrounds them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, base: list[list[tuple[str, int, int]]]):
        self.lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before a byte
        points = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.append(points, len(data))
        taken: list[list[int]] = []
        for k, own in enumerate(base):
            for a, b in sorted((a, b) for _, a, b in own):
                a, b = (int(points[self.lead[offsets[k]] + x]) for x in (a, b))
                if taken and a < taken[-1][1]:
                    taken[-1][1] = max(taken[-1][1], b)
                else:
                    taken.append([a, b])
        starts, ends, _ = words(data, offsets, _INSIDE)
        seeds = np.array(taken, np.int64).reshape(-1, 2)
        if len(seeds):  # a word that a base span touches is not a unit
            after = np.searchsorted(seeds[:, 1], starts, "right")
            free = np.append(seeds[:, 0], len(data) + 1)[after] >= ends
            starts, ends = np.append(starts[free], seeds[:, 0]), np.append(ends[free], seeds[:, 1])
        seed = np.arange(len(starts)) >= len(starts) - len(seeds)
        order = np.argsort(starts, kind="stable")
        self.starts, self.ends, self.seed = starts[order], ends[order], seed[order]
        self.first = np.searchsorted(self.starts, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        digits, foreign = (np.append(0, np.cumsum(x)) for x in (_DIGIT[data], data >= 128))
        self.shaped = (digits[self.ends] > digits[self.starts]) & (foreign[self.ends] == foreign[self.starts])
        self.shaped &= (self.ends - self.starts >= LEAST_LENGTH) & ~self.seed
        # White space as one space.
        space = ~NOT_SPACE[data]
        kept = np.ones(len(data), bool)
        kept[1:] = ~(space[1:] & space[:-1])
        place = np.append(0, np.cumsum(kept))
        folded = np.where(space, np.uint8(32), LOWER[data])[kept]
        self.rolling = Rolling(folded)
        self.low, self.high = place[self.starts], place[self.ends]

    def patterns(self, at: np.ndarray) -> np.ndarray:
        """For each of some units, in columns, the patterns it occurs with: before, after, both. 0 is none."""
        out = np.zeros((len(at), 3 * REACH), np.uint64)
        low, high = self.first[self.text[at]], self.first[self.text[at] + 1]
        for k in range(1, REACH + 1):
            salt = np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
            left, right = np.maximum(at - k, low), np.minimum(at + k, high - 1)
            before = mix(self.rolling.spans(self.low[left], self.low[at]) + salt)
            after = mix(self.rolling.spans(self.high[at], self.high[right]) ^ salt)
            has_left, has_right = at - k >= low, at + k < high
            out[:, 3 * k - 3] = np.where(has_left, before, 0)
            out[:, 3 * k - 2] = np.where(has_right, after, 0)
            out[:, 3 * k - 1] = np.where(has_left & has_right, mix(before * _ODD + after), 0)
        return out


_SPAN = "struct<kind: string, start: int, stop: int>"
_EDGE = "struct<start: int, stop: int, pattern: string, instance: string, shaped: boolean>"
_AROUND = "struct<start: int, stop: int, patterns: array<long>, instance: string, seed: boolean>"


def _prepared(docs: DataFrame) -> DataFrame:
    return in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _observed(docs: DataFrame) -> DataFrame:
    """Per document: base spans; what stands after separators, with the base spans among it; seeds and shaped words
    with the patterns around them."""

    names = ["start", "stop", "pattern", "instance", "shaped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])
        edge = pa.struct(list(zip(names, [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_()])))
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.string(), pa.bool_()]
        near = pa.struct(list(zip(["start", "stop", "patterns", "instance", "seed"], kinds)))
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in pieces(offsets):
                texts = batch.column(1).slice(i, j - i).to_pylist()
                base = [base_spans(text) for text in texts]
                spans = [[{"kind": k, "start": a, "stop": b} for k, a, b in own] for own in base]
                edges = [[dict(zip(names, c)) for c in candidates(t, own)] for t, own in zip(texts, base)]
                seeds = [[dict(zip(names, (0, 0, p, x, True))) for p, x in _contexts(t, own)] for t, own in zip(texts, base)]
                units = Surroundings(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], base)
                at = np.flatnonzero(units.shaped | units.seed)
                around: list[list[dict]] = [[] for _ in texts]
                begin = units.lead[offsets[i:j] - offsets[i]]
                text = units.text[at]
                low, high = (units.lead[x[at]] - begin[text] for x in (units.starts, units.ends))
                found = units.patterns(at).view(np.int64).tolist()
                for k, a, b, own, seed in zip(text.tolist(), low.tolist(), high.tolist(), found, units.seed[at].tolist()):
                    own = [p for p in own if p]
                    around[k].append({"start": a, "stop": b, "patterns": own, "instance": texts[k][a:b], "seed": seed})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(spans, pa.list_(span)),
                        pa.array(edges, pa.list_(edge)),
                        pa.array(seeds, pa.list_(edge)),
                        pa.array(around, pa.list_(near)),
                    ],
                    ["doc_id", "base", "edges", "seeds", "around"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _prepared(docs).mapInArrow(
        run, f"doc_id {kind}, base array<{_SPAN}>, edges array<{_EDGE}>, seeds array<{_EDGE}>, around array<{_AROUND}>"
    )


def _others(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern (long), n: occurrences around words that are neither seeds nor shaped, of at least all of ``patterns``."""
    bits = min(MOST_BITS, max(16, (64 * patterns.count()).bit_length()))
    # Four cells a pattern, from stretches of its bits.
    shifts = [(64 - bits) * k // 3 for k in range(4)]
    low = (1 << bits) - 1
    cells = F.array(*[F.shiftrightunsigned("pattern", k).bitwiseAND(F.lit(low)) for k in shifts])
    held = patterns.select(F.explode(cells).alias("cell"))
    held = held.select(F.shiftright("cell", 6).alias("at"), F.expr("1L").alias("one"), F.col("cell").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    rows = held.groupBy("at").agg(F.expr("bit_or(shiftleft(one, bit))").alias("mask")).toPandas()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows["at"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = table.view(np.uint64)

        def seen(cells: np.ndarray) -> np.ndarray:
            return marks[cells >> np.uint64(6)] >> (cells & np.uint64(63)) & np.uint64(1) > 0

        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in pieces(offsets):
                base = [base_spans(text) for text in batch.column(0).slice(i, j - i).to_pylist()]
                units = Surroundings(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], base)
                found = units.patterns(np.flatnonzero(~units.shaped & ~units.seed)).ravel()
                found = found[found > 0]
                for k in shifts:
                    found = found[seen(found >> np.uint64(k) & np.uint64(low))]
                if len(found):
                    pattern, n = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(pattern.view(np.int64)), pa.array(n, pa.int64())], ["pattern", "n"])

    return _prepared(docs).select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def _against(docs: DataFrame, patterns: DataFrame, confidence: float) -> DataFrame:
    """pattern (long), n: plain occurrences of ``patterns`` (pattern, n of its shaped occurrences and seeds).

    Every document is in one part, by a hash of its text, and every part is read. A pattern that its plain occurrences in
    earlier parts have brought under the confidence, were all its others good, can never be good again: it keeps the
    count it has, which is enough for that, and later parts do not look for it. So the many that one more text
    refutes are met in a few texts and not in all, and what is counted stays near the number of patterns.
    """
    share = F.pmod(F.xxhash64("text"), F.lit(PARTS[-1]))
    left = patterns.withColumn("plain", F.lit(0).cast("long"))
    counted: list[DataFrame] = []
    for low, high in zip([0, *PARTS], PARTS):
        found = _others(docs.filter((share >= low) & (share < high)), left.select("pattern"))
        seen = staged(left.join(found.withColumnRenamed("n", "more"), "pattern", "left").fillna(0, ["more"]), "plain-counts")
        counted.append(seen.filter("more > 0").select("pattern", F.col("more").alias("n")))
        left = seen.select("pattern", "n", (F.col("plain") + F.col("more")).alias("plain"))
        left = staged(left.filter(F.col("n") / (F.col("n") + F.col("plain")) >= confidence), "open-patterns")
    return reduce(DataFrame.unionByName, counted)


def _is_cue():
    return F.regexp_extract("pattern", r"^([a-z_]+)", 1).isin(sorted(CUES))


def _graph(docs: DataFrame, rows: DataFrame, rounds: int, confidence: float, support: int) -> DataFrame:
    """pattern, instance, n, seed, shaped: patterns by separators as text, those by surroundings as numbers.

    Plain occurrences only lower a pattern's confidence, and so that of all that depend on it. So the rounds run
    without them first: what is good in none of those rounds never is. Plain occurrences are counted for the rest.
    """
    around = staged(
        rows.select(F.explode("around").alias("e"))
        .select("e.instance", F.col("e.seed").cast("int").alias("seed"), F.explode("e.patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")),
        "pattern-instances",
    )
    often = around.groupBy("pattern").agg(F.sum("n").alias("support")).filter(F.col("support") >= support).select("pattern")
    near = around.withColumn("shaped", F.lit(True)).join(often, "pattern")
    separated = (
        rows.select(F.explode("edges").alias("e"), F.lit(0).alias("seed"))
        .unionByName(rows.select(F.explode("seeds").alias("e"), F.lit(1).alias("seed")))
        .groupBy("e.pattern", "e.instance")
        .agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"), F.max("e.shaped").alias("shaped"))
    )
    hopeful = staged(separated.unionByName(near.withColumn("pattern", F.col("pattern").cast("string"))), "hopeful-graph")
    ever = _rounds(hopeful, rounds, confidence, support)
    names = ever[0].select("pattern")
    for more in ever[1:]:
        names = names.unionByName(more.select("pattern"))
    numbered = names.select(F.col("pattern").try_cast("long").alias("pattern")).dropna().distinct()
    amounts = near.groupBy("pattern").agg(F.sum("n").alias("n"))
    against = _against(docs, staged(numbered.join(amounts, "pattern"), "hopeful-numbers"), confidence).select(
        F.col("pattern").cast("string"), F.lit("").alias("instance"), "n", F.lit(0).alias("seed"), F.lit(False).alias("shaped")
    )
    return staged(hopeful.unionByName(against), "pattern-graph")


def good_patterns(
    graph: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT
) -> DataFrame:
    """Patterns of enough confidence and support, from the graph; see ``_rounds``."""
    return _rounds(graph, rounds, confidence, support)[-1]


def _rounds(graph: DataFrame, rounds: int, confidence: float, support: int) -> list[DataFrame]:
    """The good patterns of the start and of every round.

    A pattern starts with the share of its occurrences that are seeds. A cue is one good occurrence more, and starts as
    good. An instance is as good as the best of the patterns that are good so far, so weak ones do not raise each other.
    """
    cue = _is_cue()
    prior = F.when(cue, F.lit(1)).otherwise(F.lit(0))
    enough = (F.col("confidence") >= confidence) & (F.col("support") >= support)

    def scored(rows: DataFrame, good) -> DataFrame:
        rows = rows.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum(F.col("n") * good).alias("good"))
        return rows.select("pattern", (F.col("n") + prior).alias("support"), ((F.col("good") + prior) / (F.col("n") + prior)).alias("confidence"))

    first = scored(graph, F.col("seed")).withColumn("confidence", F.when(cue, F.lit(1.0)).otherwise(F.col("confidence")))
    found = [staged(first.filter(enough), "good-patterns")]
    for _ in range(rounds):
        good = found[-1]
        instances = (
            graph.filter("shaped")
            .join(good, "pattern", "left")
            .groupBy("instance")
            .agg(F.greatest(F.max("seed").cast("double"), F.coalesce(F.max("confidence"), F.lit(0.0))).alias("good"))
            .filter("good > 0")
        )
        again = graph.filter("shaped").join(instances, "instance", "left").select("pattern", "n", F.coalesce("good", F.lit(0.0)).alias("good"))
        again = again.unionByName(graph.filter("not shaped").select("pattern", "n", F.lit(0.0).alias("good")))
        found.append(staged(scored(again, F.col("good")).filter(enough), "good-patterns"))
    return found


def scanned(
    docs: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT
) -> DataFrame:
    """One row per document: doc_id, base (spans by kind and start) and found (further spans, by start).

    Spans are in code points, ends exclusive. Null and empty texts have none; repeated rows are scanned each; other
    columns are not read. A found span never overlaps a base span.
    """
    rows = staged(_observed(docs).withColumn("row", F.monotonically_increasing_id()), "spans")
    good = good_patterns(_graph(docs, rows, rounds, confidence, support), rounds, confidence, support)
    separated = rows.select("row", F.explode("edges").alias("e")).filter("e.shaped")
    around = rows.select("row", F.explode("around").alias("e")).filter("not e.seed")
    further = (
        separated.select("row", "e.pattern", F.struct("e.start", "e.stop").alias("span"))
        .unionByName(
            around.select("row", F.explode(F.col("e.patterns").cast("array<string>")).alias("pattern"), F.struct("e.start", "e.stop").alias("span"))
        )
        .join(good.select("pattern"), "pattern")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("span")).alias("found"))
    )
    return rows.join(further, "row", "left").select(
        "doc_id", "base", F.coalesce("found", F.expr("cast(array() as array<struct<start: int, stop: int>>)")).alias("found")
    )
