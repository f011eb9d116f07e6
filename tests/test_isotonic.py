"""Isotonic fits against plain pooling of adjacent violators, with ranges cut until they are small."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import isotonic


def plain(rows):
    """(x, y, w) to {x: fit}."""
    total = {}
    for x, y, w in rows:
        if x is not None and y is not None and w > 0:
            a, b = total.get(x, (0.0, 0.0))
            total[x] = (a + y * w, b + w)
    stack = []
    for x in sorted(total):
        top = [[x], *total[x]]
        while stack and stack[-1][1] / stack[-1][2] >= top[1] / top[2]:
            before = stack.pop()
            top = [before[0] + top[0], before[1] + top[1], before[2] + top[2]]
        stack.append(top)
    return {x: s / w for xs, s, w in stack for x in xs}


def shapes(n):
    draw = random.Random(n)
    yield "noise", [(float(i), draw.gauss(0, 1), 1.0) for i in range(n)]
    yield "rising", [(float(i), i * 0.1 + draw.gauss(0, 2), draw.choice((0.5, 1.0, 3.0))) for i in range(n)]
    yield "sorted", [(float(i), float(i), 1.0) for i in range(n)]
    yield "falling", [(float(i), float(-i), 1.0) for i in range(n)]
    # inside each part rising, all in all falling: the fit is one block that no level cuts
    yield "saw", [(float(i), float(i % 50) - i * 2.0, 1.0) for i in range(n)]
    yield "steps", [(float(i), float(i // 40 % 5), 1.0) for i in range(n)]
    yield "flat", [(float(i % 97), 5.0, 1.0) for i in range(n)]
    yield "outlier", [(float(i), float(i) if i < n - 1 else -1e6, 1.0) for i in range(n)]
    yield "ties", [(float(draw.randint(0, 60)), draw.gauss(0, 1), 1.0) for _ in range(n)]


@pytest.mark.parametrize("most,levels,partitions", [(8, 3, 7), (10_000, 31, 5)])
def test_shapes(spark, most, levels, partitions):
    for name, rows in shapes(400):
        df = spark.createDataFrame(rows, "x double, y double, w double").repartition(4)
        got = {r["x"]: r["fit"] for r in isotonic.fit(df, "x", "y", "w", partitions, most, levels).collect()}
        want = plain(rows)
        assert got.keys() == want.keys(), name
        assert np.allclose([got[x] for x in sorted(want)], [want[x] for x in sorted(want)], rtol=1e-9, atol=1e-9), name


def test_pool():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 300, 3000):
        y, w = draw.normal(size=n).cumsum() * draw.choice([1, 0]) + draw.normal(size=n), draw.integers(1, 5, n).astype(float)
        starts, sums, weights = isotonic.pool(y * w, w)
        want = plain([(float(i), a, b) for i, (a, b) in enumerate(zip(y, w))])
        fit = np.repeat(sums / weights, np.diff(np.append(starts, n))) if n else np.empty(0)
        assert np.allclose(fit, [want[float(i)] for i in range(n)])
    # an outlier at the end takes the blocks back one by one
    y = np.append(np.arange(5000.0), -1e9)
    assert len(isotonic.pool(y, np.ones(5001))[0]) == 1


def test_odd_rows_and_prediction(spark):
    rows = [(1.0, 2.0, 1.0), (1.0, 4.0, 3.0), (2.0, 1.0, 1.0), (None, 1.0, 1.0), (3.0, None, 1.0), (4.0, 9.0, 1.0), (5.0, 9.0, 0.0), (6.0, 9.0, None), (8.0, 11.0, 2.0)]
    fitted = isotonic.fit(spark.createDataFrame(rows, "x double, y double, w double"), "x", "y", "w", partitions=3)
    known = {r["x"]: r["fit"] for r in fitted.collect()}
    assert known == pytest.approx({1.0: 3.0, 2.0: 3.0, 4.0: 9.0, 8.0: 11.0})
    asked = [(-3, 3.0), (1, 3.0), (2, 3.0), (3, 6.0), (4, 9.0), (5, 9.5), (7, 10.5), (8, 11.0), (100, 11.0), (3, 6.0), (None, None)]
    df = spark.createDataFrame([(x,) for x, _ in asked], "q int")
    for partitions in (1, 4, 20):
        got = sorted(((r["q"], r["fit"]) for r in isotonic.predict(fitted, df, "q", partitions).collect()), key=repr)
        assert got == sorted(asked, key=repr)
    none = spark.createDataFrame([], "x double, y double")
    assert isotonic.fit(none, "x", "y").count() == 0
    assert [r["fit"] for r in isotonic.predict(isotonic.fit(none, "x", "y"), df.limit(2), "q").collect()] == [None, None]
    text = isotonic.fit(spark.createDataFrame([(1, 2), (2, 1)], "a int, b int"), "a", "b").select(F.col("fit").cast("string")).collect()
    assert [r[0] for r in text] == ["1.5", "1.5"]
