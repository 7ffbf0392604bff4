"""Averages whose digits do not depend on row order.

A sum of doubles changes in its last digits with the order of partial sums, so a rounded average may
flip between runs on a cluster. Sensor readings carry few decimals; summing them as whole numbers of
the last decimal is exact, and its state is one long, which keeps the aggregation in the fast hash path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadflow.functions.labels import as_column


def scaled_sum(c: Column | str, decimals: int) -> Column:
    """Exact sum in units of the last decimal."""
    return F.sum(F.round(as_column(c) * float(10**decimals)).cast("long"))


def rounded_ratio(total: Column, n: Column, decimals: int, places: int = 2) -> Column:
    """total / n to ``places`` decimals, halves away from zero, in whole-number arithmetic.

    ``total`` counts units of 10 ** -decimals; NULL when n is 0.
    """
    if places < decimals:
        raise ValueError("cannot round below the recorded decimals")
    units = F.abs(total) * (10 ** (places - decimals))
    rows = F.when(n != 0, n)
    twice = rows * 2
    top = units * 2 + rows
    quotient = (top - top % twice) / twice
    return F.signum(total) * quotient / float(10**places)


def mean(c: Column | str, places: int = 2, decimals: int | None = None) -> Column:
    """Rounded average; exact when the recorded ``decimals`` of the readings are known."""
    if decimals is None:
        return F.round(F.avg(as_column(c)), places)
    return rounded_ratio(scaled_sum(c, decimals), F.count(as_column(c)), decimals, places)
