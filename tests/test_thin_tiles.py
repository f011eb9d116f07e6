"""Matrices whose cells are spread thinly over tiles: they take the room of their cells, and their products are those of numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import tiles
from test_tiles import dense, triples


def held_cells(df):
    return df.agg(F.sum(F.size("values"))).first()[0]


def scattered(seed, shape, cells):
    draw = np.random.default_rng(seed)
    m = np.zeros(shape)
    m[draw.integers(0, shape[0], cells), draw.integers(0, shape[1], cells)] = draw.integers(1, 9, cells)
    return m


def test_thin_tiles_hold_their_cells_only(spark):
    a, b = scattered(1, (700, 1900), 900), scattered(2, (1900, 20), 700)
    left, right = tiles.tile(triples(spark, a)), tiles.tile(triples(spark, b))
    assert left.count() > 250 and held_cells(left) == np.count_nonzero(a)
    assert held_cells(tiles.moved(left, 5, 9)) == np.count_nonzero(a)
    product = tiles.multiply(left, right)
    assert held_cells(product) < 3 * np.count_nonzero(a @ b)
    assert np.array_equal(dense(tiles.untile(product), (700, 20)), a @ b)


def test_a_single_tile_column_makes_no_copies_of_the_left(spark):
    left, right = tiles.tile(triples(spark, scattered(3, (700, 300), 900))), tiles.tile(triples(spark, scattered(4, (300, 20), 700)))
    assert tiles._sides(tiles._ends(left, right), 100, tiles.SIZE)[1] == 1


@pytest.mark.parametrize("cells,held", [(1, 1), (7, 2), (50, 300), (1 << 17, 3)])
def test_slices_full_sums_and_mixed_tiles(spark, cells, held, monkeypatch):
    """Groups over several slices, sums that go out early, products cut short, and full tiles beside thin ones."""
    monkeypatch.setattr(tiles, "CELLS", cells)
    monkeypatch.setattr(tiles, "PRODUCTS", max(16, cells))
    a, b = scattered(5, (40, 33), 200), scattered(6, (33, 29), 150)
    a[:8, :8], b[:8, :8] = np.arange(1.0, 65.0).reshape(8, 8), np.arange(2.0, 66.0).reshape(8, 8)
    left, right = (tiles.tile(triples(spark, m), 4) for m in (a, b))
    assert left.where("at is null").count() and left.where("at is not null").count()
    for grid in (None, 2):
        got = tiles.multiply(left, right, 4, grid=grid, held=held)
        assert got.groupBy("ti", "tj").count().where("count > 1").count() == 0
        assert np.array_equal(dense(tiles.untile(got, 4), (40, 29)), a @ b)
    assert np.array_equal(dense(tiles.untile(tiles.multiply(left, tiles.transpose(left, 4), 4, held=held, upper=True), 4).where("i <= j"), (40, 40)), np.triu(a @ a.T))
    assert np.array_equal(dense(tiles.untile(tiles.hconcat(left, right, 35, 4), 4), (40, 64))[:, :33], a)


def test_cells_that_are_not_finite_stay_with_their_partners(spark):
    a, b = np.ones((8, 8)), np.ones((8, 8))
    a[3, 2], b[2, :] = np.inf, 0
    got = dense(tiles.untile(tiles.multiply(tiles.tile(triples(spark, a), 4), tiles.tile(triples(spark, b), 4), 4), 4), (8, 8))
    assert np.array_equal(got, np.full((8, 8), 7.0))


def test_gram_wide_makes_its_rows_once_and_holds_their_cells_only(spark):
    """Rows of few cells over many columns; the rows' own work isn't done again for each side of the product."""
    x = scattered(7, (500, 1000), 4000)
    rows = [([(int(j), float(r[j])) for j in np.flatnonzero(r)],) for r in x]
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    cells = "cells array<struct<j: int, v: double>>"
    df = spark.createDataFrame(rows, cells).repartition(3).mapInArrow(count, cells)
    assert held_cells(tiles.row_tiles(df, "cells")) == np.count_nonzero(x)
    made.value = 0
    got = tiles.untile(tiles.gram_wide(df, "cells")).where("i <= j")
    assert np.array_equal(dense(got, (1000, 1000)), np.triu(x.T @ x))
    assert made.value == len(rows)
