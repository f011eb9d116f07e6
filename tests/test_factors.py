"""Alternating least squares against dense numpy; hot ids over several blocks, 64-bit ids, saved models."""

import numpy as np
import pytest

from stayline.operators import factors
from stayline.session import scratch_path

BIG = 1 << 40  # ids beyond 32 bits


def rated(spark, seed=1, users=12, items=9):
    draw = np.random.default_rng(seed)
    rows = [(int(u) + BIG, int(i) - BIG, float(draw.integers(-1, 6))) for u in range(users) for i in range(items) if draw.random() < 0.6]
    rows += [(BIG, int(i) - BIG, 3.0) for i in range(items)] + [rows[0]]  # repeated ratings count once each
    return rows, spark.createDataFrame(rows, "user long, item long, rating double").repartition(5)


def solve(rows, known, rank, reg, alpha, to, source):
    out = {}
    base = sum((np.outer(f, f) for f in known.values()), np.zeros((rank, rank))) if alpha is not None else 0
    for key in {r[to] for r in rows}:
        a, b, n = np.zeros((rank, rank)) + base, np.zeros(rank), 0
        for r in rows:
            if r[to] == key:
                f, y = known[r[source]], r[2]
                if alpha is None:
                    a, b, n = a + np.outer(f, f), b + y * f, n + 1
                else:
                    a = a + alpha * abs(y) * np.outer(f, f)
                    if y > 0:
                        b, n = b + (1 + alpha * y) * f, n + 1
        out[key] = np.linalg.solve(a + reg * n * np.eye(rank), b)
    return out


def collected(table):
    return {r["id"]: np.array(r["factors"]) for r in table.collect()}


@pytest.mark.parametrize("rank,alpha,hot,blocks", [(3, None, 100_000, 4), (2, None, 3, 5), (3, 0.4, 4, 3)])
def test_half_steps(spark, rank, alpha, hot, blocks, monkeypatch):
    monkeypatch.setattr(factors, "CHUNK", 5)
    rows, df = rated(spark)
    settings = factors.Settings(rank, 0.1, alpha, hot=hot)
    start = factors.initial(df.select(df["item"].alias("id")).distinct(), settings)
    known = collected(start)
    assert len({tuple(f) for f in known.values()}) == 9 and all(((0 <= f) & (f < 1)).all() for f in known.values())
    links = factors.Links(df, "user", "item", settings, blocks)
    got, want = collected(factors.half_step(links, start, settings)), solve(rows, known, rank, 0.1, alpha, 0, 1)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    if hot < 5:  # the ratings of the user with all items lie in several blocks
        assert links.ratings.where(f"to = {BIG}").select("block").distinct().count() > 1
    links.drop()


@pytest.mark.parametrize("alpha", [None, 0.3])
def test_sweeps_and_model_store(spark, alpha):
    rows, df = rated(spark, 2)
    settings = factors.Settings(3, 0.1, alpha, hot=4)
    model = factors.train(df.union(spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0), (1, 1, None)], df.schema)), settings, sweeps=3)
    items = collected(factors.initial(df.select(df["item"].alias("id")).distinct(), settings))
    for _ in range(3):
        users = solve(rows, items, 3, 0.1, alpha, 0, 1)
        items = solve(rows, users, 3, 0.1, alpha, 1, 0)
    got = collected(model.users), collected(model.items)
    assert all(np.allclose(got[0][k], users[k]) for k in users) and all(np.allclose(got[1][k], items[k]) for k in items)
    path = scratch_path(spark, "factors")
    model.save(path)
    again = factors.Factors.load(spark, path)
    assert again.settings.rank == 3 and again.settings.alpha == alpha
    assert model.error(df).collect() == again.error(df).collect()
    unknown = again.score(spark.createDataFrame([(5, 5, 1.0), (BIG, -BIG, 1.0)], df.schema)).collect()
    assert sorted(r["prediction"] is None for r in unknown) == [False, True]


def test_empty(spark):
    none = spark.createDataFrame([], "user long, item long, rating double")
    model = factors.train(none, sweeps=1)
    assert model.users.count() == 0 and model.score(none).count() == 0
