"""Capacity and speed as the readings show them: quantiles and least squares from sums that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def observed_capacity(
    events: DataFrame, keys: Sequence[str] = ("road_segment_id", "weather"), volume: str = "vehicle_count", share: float = 0.95
) -> DataFrame:
    """Per group the smallest volume that at least ``share`` of its readings do not exceed, and the number of readings.

    Exact, from the count of every volume: a group's rows are counted before the shuffle, and what a window holds are
    distinct volumes. Readings without a volume do not count; a null key is a group.
    """
    keys = list(keys)
    counts = events.dropna(subset=[volume]).groupBy(*keys, volume).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy(volume).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"upto": upto, "readings": F.sum("n").over(group)})
    enough = ranked.filter(F.col("upto") >= F.col("readings") * share)
    return enough.groupBy(*keys).agg(F.min(volume).alias("capacity"), F.first("readings").alias("readings"))


def fitted_line(events: DataFrame, keys: Sequence[str], x: str, y: str, y_decimals: int) -> DataFrame:
    """Per group the line of least squares of ``y`` over the whole number ``x``: readings, slope, intercept, fit (R squared).

    The sums are whole numbers of y's last decimal, so the line does not depend on the order of rows. Slope and fit
    are NULL where x (or for the fit y) does not vary.
    """
    units = F.round(F.col(y) * float(10**y_decimals)).cast("long")
    rows = events.dropna(subset=[x, y]).select(*keys, F.col(x).cast("long").alias("x"), units.alias("y"))
    sums = {"sx": "x", "sy": "y", "sxx": F.col("x") * F.col("x"), "sxy": F.col("x") * F.col("y"), "syy": F.col("y") * F.col("y")}
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("readings"), *[F.sum(c).alias(n) for n, c in sums.items()])

    def spread(a: str, b: str, both: str) -> Column:
        return (F.col("readings") * F.col(both) - F.col(a) * F.col(b)).cast("double")

    xx, xy, yy = spread("sx", "sx", "sxx"), spread("sx", "sy", "sxy"), spread("sy", "sy", "syy")
    slope = xy / F.when(xx != 0, xx)
    intercept = (F.col("sy") - slope * F.col("sx")) / F.col("readings")
    fit = xy * xy / F.when(xx * yy != 0, xx * yy)
    scale = float(10**y_decimals)
    return grouped.select(*keys, "readings", (slope / scale).alias("slope"), (intercept / scale).alias("intercept"), fit.alias("fit"))


def on_line(events: DataFrame, lines: DataFrame, keys: Sequence[str], x: str, target: str = "expected") -> DataFrame:
    """``events`` with the value that their group's line gives for their ``x``; NULL where the group has no slope."""
    found = lines.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("intercept").alias("_a"), F.col("slope").alias("_b"))
    condition = F.lit(True)
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    value = F.col("_a") + F.col("_b") * F.col(x)
    return events.join(found, condition, "left").select(*events.columns, value.alias(target))
