"""Joins, samples, matrices, metrics and graph against brute force on small fixtures."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayline.functions import vectors
from stayline.operators import features, graph, matrix, metrics, relational, sampling


@pytest.fixture
def ab(spark):
    a = spark.createDataFrame([("oak", 3.5), ("elm", 7.0), ("fir", 7.0)], "k string, x double")
    b = spark.createDataFrame([("oak", 2.5), ("fir", 6.0), ("yew", 0.5)], "k string, y double")
    return a, b


def test_full_join_equals_builtin(ab, rows):
    a, b = ab
    assert rows(relational.full_join(a, b, ["k"])) == rows(a.join(b, "k", "full"))
    assert len(rows(relational.full_join(a, b, ["k"]))) == 4


def test_full_join_keeps_null_keys_and_repeats(spark, rows):
    a = spark.createDataFrame([(None, 1), (1, 2), (1, 3)], "k int, x int")
    b = spark.createDataFrame([(None, 5), (1, 6), (1, 7), (2, 8)], "k int, y int")
    assert rows(relational.full_join(a, b, ["k"])) == rows(a.join(b, "k", "full"))


def test_left_fill(ab, rows):
    a, b = ab
    assert rows(relational.left_join_fill(a, b, ["k"], {"y": 0.0})) == [("elm", 7.0, 0.0), ("fir", 7.0, 6.0), ("oak", 3.5, 2.5)]


def test_cogroup(ab, rows):
    a, b = ab
    assert rows(relational.cogroup_values(a, b, "k", "x", "y")) == sorted(
        [("oak", "left", 3.5, 1), ("elm", "left", 7.0, 1), ("fir", "left", 7.0, 1), ("oak", "right", 2.5, 1), ("fir", "right", 6.0, 1), ("yew", "right", 0.5, 1)], key=repr)


@pytest.mark.parametrize("n", [50, 50_000])
def test_cogroup_has_one_shape_at_any_size(spark, n):
    a = spark.range(n).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as x")
    got = relational.cogroup_values(a.union(a), spark.range(10).selectExpr("'hot' as k", "id as y"), "k", "x", "y")
    assert got.columns == ["key", "side", "value", "n"] and got.count() == n + 10 and got.agg(F.sum("n")).first()[0] == 2 * n + 10


@pytest.mark.parametrize("n", [40_000, 400_000])
def test_small_shares_keep_rows(spark, n):
    rows = spark.range(n).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as c")
    for share in (0.001, 0.00004):
        got = sampling.sample_fraction(rows, "id", share, 5).count()
        assert abs(got - n * share) <= 5 * (n * share) ** 0.5 + 1
    assert abs(sampling.rebalance(rows, "id", "c", {"a": 1.00005, "b": 0.0}, 5).count() - n / 2 * 1.00005) <= 5 * (n / 40_000) ** 0.5 + 1
    parts = sampling.random_split(rows, "id", [0.99995, 0.00005], 5)
    assert parts[0].count() + parts[1].count() == n and abs(parts[1].count() - n * 0.00005) <= 5 * (n * 0.00005) ** 0.5 + 1


def test_exact_sample_of_size_zero(spark):
    rows = spark.range(100).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as c")
    assert {(r["c"], r["count"]) for r in sampling.sample_exact(rows, "id", "c", {"a": 0, "b": 5}, 1).groupBy("c").count().collect()} == {("b", 5)}
    assert sampling.sample_exact(rows, "id", "c", {"a": 0}, 1).count() == 0
    assert sampling.sample_exact(rows, "id", "c", {"a": 500, "b": 0}, 1).count() == 50


@pytest.mark.parametrize("block", [1000, 7])
def test_cartesian(spark, rows, block):
    a, b = spark.range(30).withColumnRenamed("id", "x"), spark.range(20).withColumnRenamed("id", "y")
    same = spark.range(40).selectExpr("1 as x")
    assert relational.cartesian(same, same.withColumnRenamed("x", "y"), block, block).count() == 1600
    assert relational.cartesian(same.limit(0), b, block, block).count() == 0
    assert rows(relational.cartesian(a, b, block, block)) == sorted(((x, y) for x in range(30) for y in range(20)), key=repr)


def test_cartesian_has_no_cross_join(spark):
    plan = relational.cartesian(spark.range(5), spark.range(5).withColumnRenamed("id", "y"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def number(key, seed):
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 3}, {"a": 1, "b": 500}, {"a": 199, "b": 1}])
def test_sample_exact_matches_brute_force(spark, sizes):
    data = [(i, "ab"[i % 2]) for i in range(400)]
    df = spark.createDataFrame(data, "k int, c string").repartition(7)
    got = sorted(r["k"] for r in sampling.sample_exact(df, "k", "c", sizes, 888).collect())
    want = []
    for c, n in sizes.items():
        want += sorted((k for k, d in data if d == c), key=lambda k: (number(k, 888), k))[:n]
    assert got == sorted(want)


def test_draws_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(2000).withColumn("c", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    for draw in (
        lambda d: sampling.with_split(d, "id", [0.6, 0.4], 11),
        lambda d: sampling.sample_fraction(d, "id", 0.3, 5),
        lambda d: sampling.sample_exact(d, "id", "c", {"a": 50, "b": 70}, 3),
        lambda d: sampling.rebalance(d, "id", "c", {"a": 0.3, "b": 2.5}, 9),
    ):
        assert rows(draw(df.repartition(1))) == rows(draw(df.repartition(7)))


def test_split_shares_and_folds(spark):
    df = spark.range(20_000)
    a, b = sampling.random_split(df, "id", [6, 4], 1)
    assert abs(a.count() / 20_000 - 0.6) < 0.02 and a.count() + b.count() == 20_000
    pairs = sampling.folds(df, "id", 4, 1)
    assert sum(test.count() for _, test in pairs) == 20_000
    assert all(train.count() + test.count() == 20_000 for train, test in pairs)
    train, test = sampling.folds(df, "id", 4, 1, swap=True)[0]
    assert train.count() < test.count()


def test_rebalance_counts(spark):
    df = spark.range(3000).withColumn("c", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")))
    got = dict(sampling.rebalance(df, "id", "c", {"a": 0.3, "c": 2}, 1).groupBy("c").count().collect())
    assert got["b"] == 1000 and got["c"] == 2000 and abs(got["a"] - 300) < 60


def test_minmax_modes(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert [tuple(r) for r in features.minmax_scale(df, ["x", "y"]).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert np.isnan(features.minmax_scale(df, ["y"], mode="nan").first()["y"])


def test_ratio_features_guards(spark):
    df = spark.createDataFrame([("g", 1.0, [0.0, 0.0, 0.0, 0.0, 0.0, 4.0, -1.0, 2.0])], "guid string, label double, features array<double>")
    r = features.ratio_features(df, ["guid"]).first()
    assert (r["f6_f1"], r["f6_f8"], r["f6_f7"]) == (0.0, 2.0, 0.0)


def test_coo_golden(spark, rows):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 1, 0.0), (2, 1, 4.0), (2, 1, -4.0)], "i int, j int, v double")
    assert rows(matrix.coo_build(df)) == [(0, 0, 3.0)]


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 2**31))
def test_matrix_algebra_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-2, 3, (4, 5)).astype(float), rng.integers(-2, 3, (5, 3)).astype(float)

    def table(m):
        return spark.createDataFrame([(i, j, float(m[i, j])) for i, j in np.ndindex(*m.shape)], "i int, j int, v double")

    def dense(df, shape):
        m = np.zeros(shape)
        for r in df.collect():
            m[r["i"], r["j"]] = r["v"]
        return m

    assert np.allclose(dense(matrix.coo_matmul(table(a), table(b)), (4, 3)), a @ b)
    assert np.allclose(dense(matrix.coo_transpose(table(a)), (5, 4)), a.T)
    assert np.allclose(dense(matrix.coo_hconcat(table(a), table(a), 5), (4, 10)), np.hstack([a, a]))
    assert np.allclose(dense(matrix.coo_vconcat(table(a), table(a), 4), (8, 5)), np.vstack([a, a]))
    means = {r["i"]: r["mean"] for r in matrix.coo_row_mean(table(a), 5).collect()}
    assert np.allclose([means[i] for i in range(4)], a.mean(axis=1))


def test_gram_is_the_same_for_any_partitioning(spark):
    x = np.random.default_rng(1).normal(size=(500, 6))
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "x array<double>")
    for n in (1, 7):
        got = {(r["i"], r["j"]): r["v"] for r in matrix.gram(df.repartition(n), "x").collect()}
        want = x.T @ x
        assert len(got) == 21 and all(abs(v - want[i, j]) < 1e-9 for (i, j), v in got.items())


def test_vector_goldens(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], [3.0, -4.0])], "x array<double>, y array<double>")
    r = df.select(
        vectors.argmax("x").alias("a"), vectors.argmax(F.array().cast("array<double>")).alias("e"), vectors.norm("y", 1).alias("l1"),
        vectors.norm("y", 2).alias("l2"), vectors.norm("y", float("inf")).alias("li"), vectors.append_bias("y").alias("b"),
        vectors.to_dense(vectors.to_sparse("x")).alias("d"), vectors.is_smaller_sparse("x").alias("s"),
    ).first()
    assert (r["a"], r["e"], r["l1"], r["l2"], r["li"]) == (1, -1, 7.0, 5.0, 4.0)
    assert r["b"] == [1.0, 3.0, -4.0] and r["d"] == [1.0, 3.0, 3.0] and r["s"] is False
    with pytest.raises(ValueError):
        vectors.norm("x", 0.5)


def test_vectors_from_pairs(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 0, 2.0), ("b", 1, 1.0), ("b", 1, 4.0), ("b", 9, 1.0)], "k string, index int, value double")
    got = {r["k"]: (r["vector"]["indices"], r["vector"]["values"], r["duplicates"], r["out_of_range"]) for r in vectors.from_pairs(df, "k", 5).collect()}
    assert got == {"a": ([0, 3], [2.0, 1.0], 0, 0), "b": ([1], [4.0], 1, 1)}


def test_confusion_golden(spark):
    data = [(1, 1)] * 3 + [(0, 1)] + [(0, 0)] * 4 + [(1, 0)] * 2
    df = spark.createDataFrame(data, "label int, prediction int")
    r = metrics.binary_metrics(df).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (3, 1, 4, 2)
    assert (r["accuracy"], r["precision"], r["recall"]) == (0.7, 0.75, 0.6) and r["f1"] == pytest.approx(2 / 3)
    r = metrics.binary_metrics(df, positive=0).first()
    assert (r["tp"], r["fp"]) == (4, 2)
    assert metrics.error_rate(df).first()["error_rate"] == pytest.approx(0.3)


def test_metrics_without_a_class(spark):
    df = spark.createDataFrame([(0, 0)], "label int, prediction int")
    r = metrics.binary_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"]) == (None, None, None)
    assert metrics.auc(df, score="prediction").first()["auc"] is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), min_size=2, max_size=60), st.sampled_from([2, 4, 256]))
def test_auc_matches_brute_force(spark, pairs, buckets):
    pos, neg = ([s for y, s in pairs if y == v] for v in (1, 0))
    got = metrics.auc(spark.createDataFrame(pairs, "label int, score int"), buckets=buckets).first()["auc"]
    if not pos or not neg:
        assert got is None
    else:
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert got == pytest.approx(want)


def ranks_by_hand(ids, edges, rounds):
    r, out = {i: 1.0 for i in ids}, {}
    for s, _ in edges:
        out[s] = out.get(s, 0) + 1
    for _ in range(rounds):
        r = {i: 0.15 + 0.85 * sum(r[s] / out[s] for s, d in edges if d == i) for i in ids}
    return r


@pytest.mark.parametrize("hot_degree", [1_000_000, 3])
def test_pagerank_matches_brute_force(spark, hot_degree):
    rng = random.Random(3)
    edges = sorted({(rng.choice([0, 0, *range(12)]), rng.randrange(12)) for _ in range(60)})
    v = spark.createDataFrame([(i, f"t{i}") for i in range(13)], "id bigint, title string")
    e = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r["id"]: r["rank"] for r in graph.pagerank(v, e, rounds=7, checkpoint_every=3, hot_degree=hot_degree).collect()}
    assert got == pytest.approx(ranks_by_hand(range(13), edges, 7))
    settled = {r["id"]: r["rank"] for r in graph.pagerank(v, e, tolerance=1e-6, hot_degree=hot_degree).collect()}
    assert settled == pytest.approx(ranks_by_hand(range(13), edges, 120), abs=1e-4)
    top = graph.top_ranked(v, graph.pagerank(v, e, rounds=7), 3).collect()
    assert [r["id"] for r in top] == sorted(got, key=lambda i: (-got[i], i))[:3]
