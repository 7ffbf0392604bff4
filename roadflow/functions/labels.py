"""Column helpers for text labels: trimming, canonical spelling, ranks and missing markers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadflow.functions.fixed import MISSING_MARKERS, RANKED_LEVELS


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text; empty text becomes NULL."""
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def marker_to_null(c: Column | str, markers: Iterable[str] = MISSING_MARKERS, lenient: bool = False) -> Column:
    """NULL where the text is a missing-value marker.

    ``lenient`` also catches the forms a JSON replay produces: any letter case, surrounding blanks and
    the quoted token that ``from_json`` yields when a bare NaN lands in a string field.
    """
    c = as_column(c)
    if lenient:
        plain = F.lower(F.trim(F.translate(c, '"', "")))
        return F.when(~plain.isin(sorted({m.lower() for m in markers})), c)
    return F.when(~c.isin(list(markers)), c)


def number_or_null(c: Column | str) -> Column:
    """NULL for NaN, which Spark would otherwise sort above every number."""
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def lookup(c: Column | str, pairs: Mapping, default: Column | None = None) -> Column:
    """Value of a small fixed mapping, as one CASE; ``default`` (or NULL) for other keys."""
    c = as_column(c)
    case = None
    for key, value in pairs.items():
        test = c == F.lit(key)
        case = F.when(test, value) if case is None else case.when(test, value)
    return case if default is None else case.otherwise(default)


def canonical_label(
    c: Column | str, labels: Iterable[str] = RANKED_LEVELS, aliases: Mapping[str, str] | None = None
) -> Column:
    """Canonical spelling of a known label in any letter case; unknown text passes through trimmed."""
    spelling = {label.lower(): label for label in labels}
    spelling.update({alias.lower(): label for alias, label in (aliases or {}).items()})
    return lookup(F.lower(F.trim(as_column(c))), spelling, blank_to_null(c))


def label_rank(
    c: Column | str, labels: Iterable[str] = RANKED_LEVELS, aliases: Mapping[str, str] | None = None
) -> Column:
    """1-based position of a label in its ordered domain, in any letter case; NULL when unknown."""
    order = {label.lower(): i for i, label in enumerate(labels, 1)}
    order.update({alias.lower(): order[label.lower()] for alias, label in (aliases or {}).items()})
    return lookup(F.lower(F.trim(as_column(c))), order)


def rank_label(c: Column | str, labels: Iterable[str] = RANKED_LEVELS) -> Column:
    """Label at a 1-based position of an ordered domain."""
    return lookup(c, dict(enumerate(labels, 1)))


def surrogate_key(c: Column | str) -> Column:
    """md5 of the trimmed, lower-cased label; NULL stays NULL."""
    return F.md5(F.lower(F.trim(as_column(c))))
