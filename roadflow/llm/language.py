"""Language mixtures of documents by expectation-maximisation over n-gram likelihoods.

A model holds, for each language, smoothed log-probabilities of letter trigrams (bytes, words padded by spaces,
hashed to ``BUCKETS`` cells), counted over all training documents. A document is a mixture: each of its words is drawn
from one language, with likelihood the product of its trigrams' probabilities. EM estimates the proportions. Of the
sets made of the k most likely languages, the one with the best log-likelihood less half the logarithm of the word
count per further language is selected, and its largest member is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import LOWER, giving_back, in_small_batches, pieces, text_bytes, words

BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 12
UNDETERMINED = "und"


def _letter_table() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[97:123] = inside[65:91] = True
    inside[128:] = True
    return inside


_LETTERS = _letter_table()
# A byte that is no letter becomes a space, so that words are padded alike whatever surrounds them.
_FOLDED = np.where(_LETTERS, LOWER, 32).astype(np.uint8)


def _trigram_cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of the trigram centred at every letter byte; word starts among them; first word of each text."""
    starts, ends, first = words(data, offsets, _LETTERS)
    lengths = ends - starts
    folded = np.concatenate([[32], _FOLDED[data], [32]]).astype(np.uint32)
    letters = np.zeros(len(data) + 1, np.int32)
    letters[starts] += 1
    letters[ends] -= 1
    at = np.flatnonzero(np.cumsum(letters[:-1]))
    before, here, after = folded[at], folded[at + 1], folded[at + 2]
    word_at = np.cumsum(lengths) - lengths
    if len(at):
        before[word_at] = 32
        after[word_at + lengths - 1] = 32
    cells = ((before << 16) | (here << 8) | after) * np.uint32(2654435761)
    return cells >> np.uint32(16), word_at, first


@dataclass
class Model:
    languages: list[str]
    log_probs: np.ndarray  # BUCKETS x languages


@dataclass
class Usual:
    """Log-probability of a trigram in learned texts: its mean, its variance within a text, and that of texts' means."""

    mean: float
    within: float
    between: float


LONG_TEXT = 200  # trigrams beyond which a text has no more weight, so that no single one says what is usual


def text_fits(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text its trigrams, and the sum and sum of squares of their log-probability, each word in the language that suits it best."""
    cells, word_at, first = _trigram_cells(data, offsets)
    n = len(offsets) - 1
    if not len(word_at):
        return np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    table = model.log_probs[cells]
    best = np.add.reduceat(table, word_at, axis=0).argmax(axis=1)
    length = np.diff(np.append(word_at, len(cells)))
    own = table[np.arange(len(cells)), np.repeat(best, length)].astype(float)
    text = np.repeat(np.repeat(np.arange(n), np.diff(first)), length)
    return np.bincount(text, minlength=n), np.bincount(text, own, n), np.bincount(text, own * own, n)


def usual_fit(labelled: DataFrame, model: Model) -> Usual | None:
    """How well the rows with a ``lang`` fit; None if they have no trigram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(5)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in pieces(offsets):
                count, sums, squares = text_fits(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], model)
                count, sums, squares = (v[count > 0] for v in (count, sums, squares))
                weight, mean = np.minimum(count, LONG_TEXT), sums / count
                spread = np.maximum(squares / count - mean * mean, 0.0)
                total += [(weight * v).sum() for v in (np.ones(len(mean)), mean, mean * mean, spread, spread / count)]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], _SUMS)

    rows = in_small_batches(labelled).filter("lang is not null").select(F.coalesce("text", F.lit("")).alias("text"))
    sums = rows.mapInArrow(giving_back(run), ", ".join(f"{c} double" for c in _SUMS))
    row = sums.agg(*[F.sum(c).alias(c) for c in _SUMS]).first()
    if not row.weight:
        return None
    mean, square, spread, chance = (row[c] / row.weight for c in _SUMS[1:])
    return Usual(mean, max(spread, 1e-6), max(square - mean * mean - chance, LEAST_BETWEEN))


_SUMS = ["weight", "mean", "square", "spread", "chance"]
LEAST_BETWEEN = 0.01  # learned texts that are all alike do not make every other one unusual
UNUSUAL = 18.0  # deviations below the usual fit from which on a text is in no learned language


def fit(labelled: DataFrame, smoothing: float = SMOOTHING) -> Model:
    """Trigram counts of every row with a non-null ``lang``; the model has at most BUCKETS cells a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for a, b in pieces(offsets):
                cells, word_at, first = _trigram_cells(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                edges = np.append(word_at, len(cells))[first]
                for k, name in enumerate(names[a:b]):
                    if edges[k + 1] > edges[k]:
                        own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                        own += np.bincount(cells[edges[k] : edges[k + 1]], minlength=BUCKETS)
        for name, own in counts.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(own[used])],
                ["lang", "cell", "n"],
            )

    rows = (
        in_small_batches(labelled)
        .filter("lang is not null")
        .select(F.col("lang").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(giving_back(count), "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique())
    table = np.full((BUCKETS, max(1, len(languages))), smoothing)
    for k, name in enumerate(languages):
        own = rows[rows["lang"] == name]
        table[own["cell"].to_numpy(), k] += own["n"].to_numpy()
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _shares(likelihood: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text (EM) and its log-likelihood. likelihood: words x languages; texts without words are
    not among ``first``; allowed: texts x languages."""
    counts = np.diff(np.append(first, len(likelihood)))
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for step in range(ROUNDS + 1):
        joint = likelihood * np.repeat(shares, counts, axis=0)
        total = np.maximum(joint.sum(axis=1), 1e-30)
        if step == ROUNDS:
            return shares, np.add.reduceat(np.log(total), first)
        joint /= total[:, None]
        shares = np.add.reduceat(joint, first, axis=0) / counts[:, None]
    raise AssertionError


def mixtures(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the proportions of the selected languages (0 elsewhere) and its number of words."""
    cells, word_at, first = _trigram_cells(data, offsets)
    n_words = np.diff(first)
    chosen = np.zeros((len(offsets) - 1, len(model.languages)))
    if not len(word_at):
        return chosen, n_words
    scores = np.add.reduceat(model.log_probs[cells], word_at, axis=0)
    best = scores.max(axis=1)
    likelihood = np.exp(np.maximum(scores - best[:, None], -60)).astype(np.float64)
    texts = np.flatnonzero(n_words)
    starts = first[texts]
    size = n_words[texts]
    shares, full = _shares(likelihood, starts, np.ones((len(texts), likelihood.shape[1])))
    order = np.argsort(-shares, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    penalty = 0.5 * np.log(size + 1.0)
    alone = np.add.reduceat(np.log(likelihood), starts, axis=0)
    value = alone[np.arange(len(texts)), order[:, 0]]
    picked = np.eye(likelihood.shape[1])[order[:, 0]]
    # No set fits better than all languages together, which bounds what a larger set can gain.
    for k in range(2, likelihood.shape[1] + 1):
        open_ = np.flatnonzero(full + 1e-6 - (k - 1) * penalty > value)
        if not len(open_):
            break
        rows = np.repeat(starts[open_] - np.cumsum(size[open_]) + size[open_], size[open_]) + np.arange(size[open_].sum())
        begins = np.cumsum(size[open_]) - size[open_]
        some, fitted = _shares(likelihood[rows], begins, (rank[open_] < k).astype(float))
        gain = fitted - (k - 1) * penalty[open_]
        better = gain > value[open_]
        value[open_[better]] = gain[better]
        picked[open_[better]] = some[better]
    chosen[texts] = picked
    return chosen, n_words


def predicted(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """One row per document: key, lang_pred, score (the share of that language) and languages (all selected).

    Null texts, texts without a letter and any text under a model without languages give ``und`` with score 0.
    Repeated rows are predicted each. No column but the text is an input of a prediction.
    """
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in pieces(offsets):
                part = offsets[a : b + 1] - offsets[a]
                shares, n_words = mixtures(data[offsets[a] : offsets[b]], part, model)
                names, scores, sets = [], [], []
                for k in range(b - a):
                    if not languages or not letters[a + k] or not n_words[k]:
                        names.append(UNDETERMINED), scores.append(0.0), sets.append([])
                        continue
                    top = int(shares[k].argmax())
                    names.append(languages[top])
                    scores.append(min(1.0, float(shares[k, top])))
                    sets.append([languages[j] for j in np.flatnonzero(shares[k] > 0)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(sets, pa.list_(pa.string())),
                    ],
                    [key, "lang_pred", "score", "languages"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = in_small_batches(docs).select(F.col(key), F.coalesce("text", F.lit("")).alias("text"), has_letter(F.col("text")).alias("letters"))
    return rows.mapInArrow(giving_back(run), f"{key} {kind}, lang_pred string, score double, languages array<string>")


def has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text, modulo 4, is 2 (null id: learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and predicts all: doc_id, held_out and ``predicted``'s columns."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text"))
    rows = predicted(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def with_language(docs: DataFrame, least: float = 0.3, unusual: float = UNUSUAL) -> DataFrame:
    """``docs`` without those that have no language: no letter, no language with a share of ``least``, or a text that no learned language fits.

    The last is absolute: the mean log-probability of a text's trigrams lies more than ``unusual`` deviations below that of the learned
    texts, a deviation made of how learned texts differ and of the chance in so few trigrams. So texts in other languages or scripts
    go, and dumps of keys, though some language always suits them best. The columns stay as they are. Learned from the rows with a ``lang``
    that are not held out.
    """
    docs = in_small_batches(docs)
    learned = docs.filter(~held_out(F.col("doc_id"))).select("lang", "text")
    model = fit(learned)
    usual = usual_fit(learned, model) if model.languages else None
    if usual is None:  # nothing to learn from, so nothing can be rejected for its language
        return docs.filter(has_letter(F.col("text")))
    good = _accepted(model, usual, least, unusual)
    return docs.filter(has_letter(F.col("text"))).filter(good(F.coalesce("text", F.lit(""))))


def deviations(count: np.ndarray, sums: np.ndarray, usual: Usual) -> np.ndarray:
    """How far each text's fit lies above the usual one, in deviations; 0 for texts without trigrams."""
    n = np.maximum(count, 1)
    return np.where(count > 0, (sums / n - usual.mean) / np.sqrt(usual.between + usual.within / n), 0.0)


def _accepted(model: Model, usual: Usual, least: float, unusual: float):
    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        out = []
        for a, b in pieces(offsets):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            shares, _ = mixtures(part, at, model)
            count, sums, _ = text_fits(part, at, model)
            out.append((shares.max(axis=1) >= least) & (deviations(count, sums, usual) >= -unusual))
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return accepted
