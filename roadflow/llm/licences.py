"""Licence statements in whole texts.

Words are runs of a-z, digits and non-ASCII characters after lower-casing A-Z. An Aho-Corasick automaton runs over
the words joined by single spaces and finds notice phrases and the tag ``SPDX-License-Identifier``. What follows a tag
on its line is read as a licence expression: a shunting-yard parser orders identifiers, AND, OR, WITH and brackets,
and the expression is evaluated against the set of permitted licences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.llm.arrays import LOWER, in_small_batches, pieces, ranges, text_bytes, words

# The base phrases, further phrases, and the licences an expression may use freely.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
FURTHER = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons": "cc",
    "gnu free documentation license": "gfdl",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "public domain": "public-domain",
}
PERMITTED = {
    "0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "cc0-1.0", "isc", "mit", "unlicense", "zlib",
}
TAG = "spdx license identifier"
TAG_WEIGHT, PHRASE_WEIGHT = 0.95, 0.8

RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")


def _inside() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


INSIDE = _inside()


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: identifiers and operators in postfix order; None if no expression begins the text.

    Reading stops where a token cannot follow; what was complete before it counts.
    """
    out, waiting, at, operand = [], [], 0, True
    while match := _TOKEN.match(expression, at):
        token = match[1].lower().rstrip(".,;:") if match[1] not in "()" else match[1]
        if operand and token == "(":
            waiting.append(token)
        elif operand and token not in RANK and token not in "()":
            out.append(token)
            operand = False
        elif not operand and token in RANK:
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        elif not operand and token == ")" and "(" in waiting:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            break
        at = match.end()
    if operand and waiting and waiting[-1] in RANK and out:  # an operator without a right side
        waiting.pop()
    elif operand:
        return None
    out += [t for t in reversed(waiting) if t != "("]
    return out


def evaluated(order: list[str], permitted: set[str] = PERMITTED) -> tuple[bool, set[str]]:
    """Whether the licences allow free use, and the identifiers named. WITH keeps its left side's answer."""
    stack: list[tuple[bool, set[str]]] = []
    for token in order:
        if token not in RANK:
            stack.append((token in permitted, {token}))
            continue
        (right, names), (left, more) = stack.pop(), stack.pop()
        value = left if token == "with" else (left and right) if token == "and" else (left or right)
        stack.append((value, more if token == "with" else names | more))
    return stack[0]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[str, np.ndarray]:
    """All words, each followed by a space (the last of a text by a line end), and where each begins."""
    lengths = ends - starts
    begins = np.cumsum(lengths + 1) - lengths - 1
    padded = np.append(LOWER[data], np.uint8(32))
    flat = padded[ranges(starts, lengths + 1)]
    flat[begins + lengths] = 32
    last = first[1:][np.diff(first) > 0] - 1
    flat[(begins + lengths)[last]] = 10
    return flat.tobytes().decode("latin-1"), begins


def scanned(docs: DataFrame, base=BASE, further=FURTHER, permitted=PERMITTED) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, permitted.

    ``first_word`` and ``last_word`` are the smallest and largest start of a base phrase. ``labels`` are the base ones,
    those of further phrases and the identifiers of expressions; ``permitted`` says whether every expression allows
    free use (null without one). The score is the chance that some evidence holds, phrases and tags taken as
    independent. Null and empty texts have no words; repeated rows are scanned each; other columns are not read.
    """
    phrases = {**further, **base}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for phrase in [*phrases, TAG]:
            machine.add_word(phrase.encode().decode("latin-1"), phrase)
        machine.make_automaton()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                yield _scan(batch.column(0).slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], machine)

    def _scan(ids, data, offsets, machine) -> pa.RecordBatch:
        n = len(ids)
        starts, ends, first = words(data, offsets, INSIDE)
        text, begins = _joined(data, starts, ends, first)
        raw = data.tobytes()
        places: list[list[int]] = [[] for _ in range(n)]
        basic: list[set] = [set() for _ in range(n)]
        labels: list[set] = [set() for _ in range(n)]
        tags: list[list[bool]] = [[] for _ in range(n)]
        for end, phrase in machine.iter(text):
            size = len(phrase.encode())
            at = end - size + 1
            if (at and text[at - 1] not in " \n") or text[end + 1] not in " \n":
                continue
            word = int(np.searchsorted(begins, at))
            doc = int(np.searchsorted(first, word, "right")) - 1
            if phrase == TAG:
                begin = int(ends[word + 2])
                stop = raw.find(b"\n", begin, int(offsets[doc + 1]))
                tail = raw[begin : stop if stop >= 0 else int(offsets[doc + 1])]
                order = postfix(tail.decode("utf-8", "ignore").lstrip(": \t"))
                if order:
                    free, names = evaluated(order, permitted)
                    tags[doc].append(free)
                    labels[doc] |= names
                continue
            labels[doc].add(phrases[phrase])
            if phrase in base:
                basic[doc].add(phrases[phrase])
                places[doc].append(word - int(first[doc]))
        score = [
            1 - (1 - TAG_WEIGHT) ** len(tags[k]) * (1 - PHRASE_WEIGHT) ** len(labels[k]) if labels[k] else 0.0
            for k in range(n)
        ]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(np.diff(first), pa.int64()),
                pa.array([len(p) for p in places], pa.int64()),
                pa.array([min(p) if p else None for p in places], pa.int64()),
                pa.array([max(p) if p else None for p in places], pa.int64()),
                pa.array([",".join(sorted(s)) for s in basic], pa.string()),
                pa.array([",".join(sorted(s)) for s in labels], pa.string()),
                pa.array(score, pa.float64()),
                pa.array([all(t) if t else None for t in tags], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permitted"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, permitted boolean",
    )
