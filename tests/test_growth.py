"""K-means and split search against plain versions; permutations and exact batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import clusters, sampling, splits
from stayline.session import scratch_path


def blobs(spark, n=300, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3)) * 0.2 + draw.integers(0, 4, n)[:, None] * [3.0, -2.0, 1.0]
    return x, spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)] + [(n, None)], "id int, x array<double>").repartition(4)


def test_lloyd_against_plain_rounds(spark):
    x, df = blobs(spark)
    centres = x[[5, 6, 7, 8]]
    far_off = np.vstack([centres, [[1e6, 1e6, 1e6]]])
    got = clusters.lloyd(df, "x", far_off, rounds=3)
    want, costs = far_off.copy(), []
    for _ in range(4):
        d = ((x[:, None] - want[None]) ** 2).sum(axis=2)
        costs.append(d.min(axis=1).sum())
        if len(costs) < 4:
            at = d.argmin(axis=1)
            want = np.array([x[at == k].mean(axis=0) if (at == k).any() else want[k] for k in range(5)])
    assert np.allclose(got.centres, want) and np.allclose(got.history, costs) and got.cost == pytest.approx(costs[-1])
    assert got.sizes.tolist() == np.bincount(d.argmin(axis=1), minlength=5).tolist() and got.centres[4][0] == 1e6
    assert len(clusters.lloyd(df, "x", got.centres, 50, tolerance=1e9).history) == 2


def test_start_fit_and_store(spark):
    x, df = blobs(spark)
    start = clusters.start(df, "x", "id", 4)
    assert np.array_equal(start, clusters.start(df.repartition(9), "x", "id", 4)) and len(start) == 4
    model = clusters.fit(df, "x", "id", 4)
    assert model.cost < 0.3 * len(x) and sorted(model.history, reverse=True) == pytest.approx(model.history)
    path = scratch_path(spark, "clusters")
    model.save(spark, path)
    again = clusters.Clusters.load(spark, path)
    assert np.array_equal(again.centres, model.centres) and again.cost == model.cost
    rows = again.assign(df, "x").collect()
    assert len(rows) == len(x) + 1 and sum(r["distance"] or 0 for r in rows) == pytest.approx(model.cost)
    assert [r["cluster"] for r in rows if r["x"] is None] == [None]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id int, x array<double>")
    assert len(clusters.start(same, "x", "id", 3)) == 1
    assert len(clusters.fit(same.limit(0), "x", "id", 3).centres) == 0


def impurity(y, classes):
    if classes is None:
        return float(((y - y.mean()) ** 2).sum()) if len(y) else 0.0
    return len(y) - float((np.bincount(y.astype(int), minlength=classes) ** 2).sum()) / max(len(y), 1)


def plain_tree(x, y, bounds, depth, classes, least_rows):
    found, level = {}, {1: np.arange(len(y))}
    for _ in range(depth):
        below = {}
        for node, own in level.items():
            best = None
            for f, bs in enumerate(bounds):
                for t in bs:
                    left, right = own[x[own, f] <= t], own[~(x[own, f] <= t)]
                    if min(len(left), len(right)) >= least_rows:
                        gain = (impurity(y[own], classes) - impurity(y[left], classes) - impurity(y[right], classes)) / len(own)
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, t, left, right)
            if best:
                found[node] = (best[1], best[2], len(own), len(best[3]))
                below[2 * node], below[2 * node + 1] = best[3], best[4]
        level = below
    return found


@pytest.mark.parametrize("classes,least_rows", [(3, 1), (None, 5)])
def test_trees_against_plain_search(spark, classes, least_rows):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(200, 3)).round(2)
    x[::17, 1] = np.nan
    y = ((x[:, 0] > 0.2) + (np.nan_to_num(x[:, 1]) > 0) * (x[:, 0] > 0)).astype(float) if classes else x[:, 0] ** 2 + x[:, 2]
    rows = [(float(v), [float(a) for a in r]) for r, v in zip(x, y)] + [(None, [0.0, 0.0, 0.0]), (1.0, None)]
    df = spark.createDataFrame(rows, "y double, features array<double>").repartition(3)
    for bounds in (splits.width_bounds(df.where("not isnan(features[1])"), "features", 3, 8), splits.quantile_bounds(df, "features", 3, 5)):
        got = splits.grow(df, "y", "features", bounds, 3, classes, least_rows)
        assert {r["node"]: (r["feature"], r["threshold"], r["n"], r["left_n"]) for r in got.collect()} == plain_tree(x, y, bounds, 3, classes, least_rows)
        deep = splits.leaves(df.where("y is not null and features is not null"), "features", got, 3)
        assert deep.count() == 200 and deep.where("node > 1").count() == 200
    assert splits.grow(df.limit(0), "y", "features", [[0.0]] * 3, 2, classes).count() == 0
    one = splits.grow(df.withColumn("y", F.lit(1.0)), "y", "features", bounds, 2, classes)
    assert one.count() == 0


def test_permutations(spark):
    for n in (1, 2, 3, 7, 50, 101, 1000):
        got = [r[0] for r in spark.range(n).select(sampling.permuted(F.col("id"), n, 3)).collect()]
        assert sorted(got) == list(range(n)), n
    a, b = ([r[0] for r in spark.range(1000).select(sampling.permuted(F.col("id"), 1000, s)).collect()] for s in (1, 2))
    assert a != b and abs(np.corrcoef(a, range(1000))[0, 1]) < 0.15


def test_minibatches_are_exact(spark):
    keys = random.Random(1).sample(range(10**9), 103)
    df = spark.createDataFrame([(k, str(k)) for k in keys], "id long, batch_of string")
    seen = {}
    for parts in (1, 6):
        got = sampling.minibatches(df.repartition(parts), "id", 25, 9, epoch=1).collect()
        assert sorted(r["id"] for r in got) == sorted(keys)
        assert np.bincount([r["batch"] for r in got]).tolist() == [25, 25, 25, 25, 3]
        assert len({(r["batch"], r["place"]) for r in got}) == 103
        seen[parts] = sorted(map(tuple, got))
    assert seen[1] == seen[6]
    assert seen[1] != sorted(map(tuple, sampling.minibatches(df, "id", 25, 9, epoch=2).collect()))
    ranked, n = sampling.ranked(df, "id")
    assert n == 103 and [r["id"] for r in ranked.orderBy("rank").collect()] == sorted(keys)
    assert sampling.minibatches(df.limit(0), "id", 25, 9).count() == 0
