"""Array partials and block matrices against numpy; one inner index must not be one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import matrix, partials, tiles


def triples(spark, m, dealt=4):
    rows = [(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "i long, j long, v double").repartition(dealt)


def dense(coo, shape):
    out = np.zeros(shape)
    for r in coo.collect():
        out[r["i"], r["j"]] += r["v"]
    return out


def sparse(seed, *shape):
    draw = np.random.default_rng(seed)
    return np.where(draw.random(shape) < 0.4, draw.integers(-3, 4, shape), 0).astype(float)


def test_add_up(spark):
    draw = np.random.default_rng(2)
    rows = [(f"k{i % 5}" if i % 7 else None, i % 2, draw.integers(-5, 6, 1 + i % 4).astype(float).tolist()) for i in range(300)] + [("k1", 0, None), ("k1", 1, [])]
    want = {}
    for k, n, v in rows:
        if v is not None:
            want[k, n] = partials.plus(want.get((k, n)), np.array(v))
    df = spark.createDataFrame(rows, "kind string, row int, values array<double>")
    for dealt in (1, 3, 40):
        got = {(r["kind"], r["row"]): r["values"] for r in partials.add_up(df.repartition(dealt), ["kind", "row"]).collect()}
        assert got.keys() == want.keys() and all(got[k] == want[k].tolist() for k in want)
    assert partials.add_up(df.limit(0), ["kind", "row"]).count() == 0


def test_vector_sum(spark):
    rows = [([1.0, None, 3.0],), ([2.0],), (None,), ([],), ([1.0, 1.0, 1.0, float(5)],)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(3)
    assert sorted(map(tuple, matrix.vector_sum(df, "x").collect())) == [(0, 4.0, 3), (1, 1.0, 1), (2, 4.0, 2), (3, 5.0, 1)]
    assert matrix.vector_sum(df.limit(0), "x").count() == 0


@pytest.mark.parametrize("size", [1, 3, 64])
def test_product_transpose_concat(spark, size):
    a, b = sparse(1, 7, 11), sparse(2, 11, 5)
    ta, tb = (tiles.tile(triples(spark, m), size) for m in (a, b))
    assert np.array_equal(dense(tiles.untile(tiles.multiply(ta, tb, size), size), (7, 5)), a @ b)
    assert np.array_equal(dense(tiles.untile(tiles.multiply(ta, tb, size, grid=3, held=2), size), (7, 5)), a @ b)
    assert np.array_equal(dense(tiles.untile(tiles.transpose(ta, size), size), (11, 7)), a.T)
    both = tiles.hconcat(ta, ta, 11, size)
    assert np.array_equal(dense(tiles.untile(both, size), (7, 22)), np.hstack([a, a]))
    assert np.array_equal(dense(tiles.untile(tiles.vconcat(tb, tb, 11, size), size), (22, 5)), np.vstack([b, b]))
    assert both.groupBy("ti", "tj").count().where("count > 1").count() == 0


def test_repeated_cells_and_empty(spark):
    df = spark.createDataFrame([(0, 0, 2.0), (0, 0, 3.0), (5, 1, 4.0), (5, 1, -4.0), (2, 2, None)], "i long, j long, v double")
    assert list(map(tuple, tiles.untile(tiles.tile(df, 2), 2).collect())) == [(0, 0, 5.0)]
    none = tiles.tile(df.limit(0), 2)
    assert tiles.multiply(none, none, 2).count() == 0 and tiles.add(none, none).count() == 0


def test_one_inner_index_spreads(spark):
    """An outer product has a single inner index; the grid deals its tile pairs to many tasks."""
    a, b = np.arange(1.0, 41.0)[:, None], np.arange(1.0, 31.0)[None, :]
    left, right = tiles.tile(triples(spark, a), 2), tiles.tile(triples(spark, b), 2)
    assert tiles._grid(left, right) == 3 and tiles._grid(tiles.tile(triples(spark, sparse(3, 40, 40)), 2), right) == 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = tiles.multiply(left, right, 2)
        assert np.array_equal(dense(tiles.untile(got, 2), (40, 30)), a @ b)
        copies = F.explode(F.sequence(F.lit(0), F.lit(2)))
        dealt = left.select(F.col("tj").alias("k"), (F.col("ti") % 3).alias("row"), copies.alias("col")).distinct()
        assert dealt.count() == 9
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("size", [2, 16])
def test_gram_wide(spark, size):
    x = sparse(4, 60, 23)
    rows = [([(int(j), float(r[j])) for j in np.flatnonzero(r)],) for r in x] + [(None,), ([],), ([(3, 1.0), (3, 2.0)],)]
    df = spark.createDataFrame(rows, "cells array<struct<j: int, v: double>>").repartition(4)
    x = np.vstack([x, np.eye(23)[3] * 3])
    got = tiles.untile(tiles.gram_wide(df, "cells", size), size).where("i <= j")
    assert np.array_equal(dense(got, (23, 23)), np.triu(x.T @ x))
