import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflow.operators import fits


def test_capacity_is_the_exact_quantile(spark):
    rng = np.random.default_rng(1)
    rows = [("a", None, int(v)) for v in rng.integers(0, 50, 333)] + [("b", "Rain", 7), ("b", "Rain", None), ("c", "Rain", None)]
    found = {r.k: r for r in fits.observed_capacity(spark.createDataFrame(rows, "k string, w string, v int"), ["k", "w"], "v").collect()}
    values = sorted(r[2] for r in rows if r[0] == "a")
    assert found["a"].capacity == next(v for v in values if sum(x <= v for x in values) >= 0.95 * 333)
    assert (found["a"].readings, found["b"].capacity, found["b"].readings) == (333, 7, 1) and "c" not in found


def test_line_is_that_of_least_squares(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 60, 500)
    y = np.round(70 - 0.8 * x + rng.normal(0, 3, 500), 2)
    rows = [("a", int(i), float(j)) for i, j in zip(x, y)] + [("b", 5, 3.0), ("b", 5, 4.0), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x int, y double")
    lines = fits.fitted_line(df, ["k"], "x", "y", 2)
    found = {r.k: r for r in lines.collect()}
    slope, intercept = np.polyfit(x, y, 1)
    assert (found["a"].slope, found["a"].intercept) == pytest.approx((slope, intercept))
    assert found["a"].fit == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
    assert found["b"].slope is None and "c" not in found
    again = {r.k: r for r in fits.fitted_line(df.repartition(7, F.rand(3)), ["k"], "x", "y", 2).collect()}
    assert again == found
    out = fits.on_line(df, lines, ["k"], "x").filter("k = 'a' AND x = 10").first()
    assert out.expected == pytest.approx(intercept + slope * 10)
