"""Trained models: quality bounds, gradients, networks, end-to-end jobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import descent, isotonic, models, neural
from stayline.plans import jobs
from stayline.session import scratch_path
from stayline.sources import views


@pytest.fixture(scope="module")
def plane(spark):
    """y = 2 + 3·x1 - x2 and a class split by it."""
    df = spark.range(2000).select(
        F.lit(1.0).alias("b"), F.rand(1).alias("x1"), F.rand(2).alias("x2")
    ).withColumn("y", 2 + 3 * F.col("x1") - F.col("x2"))
    return df.withColumn("c", F.when(F.col("y") > 3, 1.0).otherwise(0.0)).persist()


def test_linear_descent_converges(plane):
    fit = descent.linear(plane, ["b", "x1", "x2"], "y", steps=60, step=1.0, decay=False)
    assert fit.history[-1] < 0.02 and fit.history[0] > fit.history[-1]
    assert len(descent.linear(plane, ["b"], "y", steps=60, step=0.5, stop_loss=1.0).history) < 60


def test_logistic_and_svm_separate(plane):
    for fit in (descent.logistic(plane, ["b", "x1", "x2"], "c", 40, 5.0), descent.svm_l1(plane, ["b", "x1", "x2"], "c", 40, 2.0, 0.001)):
        z = descent.score(["b", "x1", "x2"], fit.weights)
        hit = plane.agg(F.avg(F.when((z > 0) == (F.col("c") > 0), 1.0).otherwise(0.0))).first()[0]
        assert hit > 0.85


def test_svm_l1_zeroes_useless_weights(plane):
    fit = descent.svm_l1(plane.withColumn("noise", F.rand(9) - 0.5), ["b", "x1", "x2", "noise"], "c", 30, 1.0, 0.1)
    assert fit.weights[3] == 0.0


def test_multinomial_gradient_is_the_slope(plane):
    cols, w = ["b", "x1", "x2"], [[0.3, -0.2, 0.1], [5.0, 2.0, -1.0]]
    df = plane.withColumn("k", F.pmod(F.hash("x1"), F.lit(3)))
    base = descent.multinomial_loss(df, cols, "k", w).first()
    for i, j in ((0, 1), (1, 2)):
        moved = [list(v) for v in w]
        moved[i][j] += 1e-5
        slope = (descent.multinomial_loss(df, cols, "k", moved).first()["loss"] - base["loss"]) / 1e-5
        assert slope == pytest.approx(base[f"g{i + 1}_{j}"], rel=1e-3, abs=1e-2)
    huge = descent.multinomial_loss(df, cols, "k", [[900.0] * 3, [-900.0] * 3]).first()
    assert np.isfinite(huge["loss"])


def test_ml_models_learn(plane):
    df = models.as_vectors(plane.select(F.col("c").alias("label"), F.array("x1", "x2").alias("features"))).persist()
    for estimator in (models.decision_tree(), models.random_forest(trees=5, depth=5), models.boosted_trees(rounds=3, depth=3),
                      models.linear_svm(steps=20), models.logistic_regression(), models.logistic_regression_lbfgs()):
        scored = estimator.fit(df).transform(df)
        assert scored.where("label = prediction").count() / 2000 > 0.85, estimator
    flat = models.as_vectors(plane.select(F.col("y").alias("label"), F.array("x1", "x2").alias("features")))
    for estimator in (models.linear_regression(), models.tree_regressor()):
        scored = estimator.fit(flat).transform(flat)
        assert scored.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0] < 0.05


def test_kmeans_golden(spark):
    points = [[-4.0, 2.0], [-4.5, 2.5], [-3.5, 1.5], [6.0, -1.0], [6.4, -1.2], [5.6, -0.8], [6.0, -1.0]]
    df = models.as_vectors(spark.createDataFrame([(p,) for p in points], "features array<double>"))
    model = models.kmeans(k=2).fit(df)
    assert np.allclose(sorted(c.tolist() for c in model.clusterCenters()), [[-4.0, 2.0], [6.0, -1.0]])
    assert model.summary.trainingCost == pytest.approx(1.4)
    cost = models.assign_nearest(spark.createDataFrame([(p,) for p in points], "x array<double>"), "x", [[-4.0, 2.0], [6.0, -1.0]])
    assert cost.agg(F.sum("distance")).first()[0] == pytest.approx(1.4)


def test_isotonic_matches_pool_adjacent(spark):
    ys = [1.0, 3.0, 2.0, 2.0, 5.0, 4.0]
    df = spark.createDataFrame([(float(i), y) for i, y in enumerate(ys)], "x double, y double")
    got = [r["fit"] for r in isotonic.fit(df, "x", "y").orderBy("x").collect()]
    assert got == pytest.approx([1.0, 7 / 3, 7 / 3, 7 / 3, 4.5, 4.5])


def test_naive_bayes_forms_agree(spark):
    df = spark.createDataFrame([(i % 2, float(i % 5 + 3 * (i % 2)), float(i % 3)) for i in range(60)], "label int, a double, b double")
    rows = models.naive_bayes_table(df, "label", ["a", "b"])
    mine = models.naive_bayes_score(df, rows, ["a", "b"])
    ml = models.as_vectors(df.select(F.col("label").cast("double").alias("label"), F.array("a", "b").alias("features")))
    theirs = models.naive_bayes().fit(ml).transform(ml)
    assert sorted((r["a"], r["b"], float(r["prediction"])) for r in mine.collect()) == sorted(
        (float(r["features"][0]), float(r["features"][1]), r["prediction"]) for r in theirs.collect()
    )


def test_text_stages(spark):
    said = ["please cancel my plan", "refund and cancel today", "love the new season", "great picture and sound", "cancel now", "season finale was great"]
    train = spark.createDataFrame([(i, t, float("cancel" in t)) for i, t in enumerate(said)], "id bigint, text string, label double")
    test = spark.createDataFrame([(10, "we want to cancel"), (11, "great sound")], "id bigint, text string")
    got = {r["id"]: r["prediction"] for r in models.text_stages().fit(train).transform(test).collect()}
    assert got == {10: 1.0, 11: 0.0}


def test_partitions_not_rows_shape_a_model(spark):
    """The same rows in another layout give the same forest."""
    rows = spark.range(3000).selectExpr("id", "cast(id % 7 > 3 as double) as label", "array(cast(id % 11 as double), cast(id % 5 as double)) as features")
    fits = [models.fit(models.random_forest(trees=3, depth=4), models.as_vectors(rows.repartition(n)), "id").toDebugString.split("\n", 1)[1] for n in (1, 9)]
    assert fits[0] == fits[1]


def test_many_mini_batches(spark):
    rows = spark.range(400).selectExpr("id", "array(1.0D) as label", "array(cast(id as double)) as features")
    for folders in (3, 1024):
        batches = neural.Batches(rows, 10, seed=1, folders=folders)
        assert batches.count == 40
        seen = [r["id"] for i in range(batches.count) for r in batches.batch(0, i).select("id").collect()]
        assert sorted(seen) == list(range(400))


def test_als_fits_ratings(spark):
    df = spark.createDataFrame([(u, i, 5.0 if (u + i) % 2 else 1.0) for u in range(8) for i in range(8)], "user int, item int, rating float")
    scored = models.als(rank=2, steps=10).fit(df).transform(df)
    assert scored.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0] < 0.05


# ---- networks -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def xor(spark):
    data = [(i, [float((i % 2) ^ (i // 2 % 2))], [float(i % 2), float(i // 2 % 2)]) for i in range(400)]
    return spark.createDataFrame(data, "id bigint, label array<double>, features array<double>").repartition(3).persist()


@pytest.mark.parametrize("hidden, output", [("sigmoid", "sigmoid"), ("scaled_tanh", "linear")])
def test_backward_is_the_slope(hidden, output):
    rng = np.random.default_rng(0)
    cfg = neural.NetConfig((3, 4, 2), hidden=hidden, output=output)
    W = neural.initial_weights(cfg.size, 1)
    x, y = rng.normal(size=(5, 3)), rng.uniform(size=(5, 2))

    def loss(weights):
        e = y - neural.forward(x, weights, cfg)[0][-1]
        return 0.5 * (e * e).sum()

    acts, masks = neural.forward(x, W, cfg)
    grads = neural.backward(y, acts, masks, W, cfg, None)
    for k, w in enumerate(W):
        for i, j in np.ndindex(*w.shape):
            up = [v.copy() for v in W]
            up[k][i, j] += 1e-6
            assert (loss(up) - loss(W)) / 1e-6 == pytest.approx(grads[k][i, j], rel=1e-3, abs=1e-5)


def test_network_learns_xor(xor):
    cfg = neural.NetConfig((2, 6, 1), hidden="scaled_tanh", output="linear", rate=0.1, momentum=0.5, seed=1)
    model = neural.net_train(xor, cfg, batch_rows=400, epochs=25)
    assert model.history[-1]["train"] < model.history[0]["train"] and model.history[-1]["train"] < 0.05
    wrong = model.predict(xor).where((F.col("prediction")[0] > 0.5) != (F.col("label")[0] > 0.5)).count()
    assert wrong == 0


def test_gradient_does_not_depend_on_partitioning(xor):
    cfg = neural.NetConfig((2, 4, 1), dropout=0.3, input_zeroed=0.2, seed=5)
    W = neural.initial_weights(cfg.size, 5)
    a, b = (neural.net_gradient(xor.repartition(n), cfg, W, epoch=1) for n in (1, 7))
    assert all(np.allclose(x, y, atol=1e-12) for x, y in zip(a[0], b[0])) and a[1] == pytest.approx(b[1])
    other = neural.net_gradient(xor, cfg, W, epoch=2)
    assert not np.allclose(a[0][0], other[0][0])


def test_mini_batches_partition_an_epoch(xor):
    batches = neural.Batches(xor, batch_rows=90, seed=4)
    assert batches.count == 4
    for epoch in (0, 1):
        seen = [r["id"] for i in range(batches.count) for r in batches.batch(epoch, i).select("id").collect()]
        assert sorted(seen) == list(range(400))
    first = {r["id"] for r in batches.batch(0, 0).select("id").collect()}
    assert first != {r["id"] for r in batches.batch(1, 0).select("id").collect()}


def test_all_network_options_run(spark, xor):
    cfg = neural.NetConfig((2, 5, 4, 1), hidden="sigmoid", output="linear", rate=0.1, momentum=0.3, rate_decay=0.9, weight_penalty=0.01,
                           sparsity_penalty=0.1, input_zeroed=0.1, dropout=0.2)
    model = neural.net_train(xor, cfg, batch_rows=150, epochs=2, validation=0.25)
    assert len(model.history) == 2 and all(np.isfinite(h["train"]) and np.isfinite(h["validation"]) for h in model.history)
    path = scratch_path(spark, "net")
    model.save(spark, path)
    again = neural.NetModel.load(spark, path, cfg)
    assert all(np.array_equal(a, b) for a, b in zip(model.weights, again.weights))
    assert again.loss(xor) == pytest.approx(model.loss(xor))


def test_step_rule():
    W, V, G = [np.array([[1.0, 2.0]])], [np.array([[0.5, 0.5]])], [np.array([[0.1, 0.2]])]
    cfg = neural.NetConfig((1, 1), momentum=0.5, weight_penalty=0.1)
    w, v = neural.apply_step(W, V, G, cfg, rate=2.0)
    assert np.allclose(v[0], [[2 * 0.1 + 0.25, 2 * (0.2 + 0.2) + 0.25]]) and np.allclose(w[0], W[0] - v[0])
    legacy = neural.NetConfig((1, 1), momentum=0.0, weight_penalty=0.1, legacy_penalty=True)
    assert np.allclose(neural.apply_step(W, V, G, legacy, 1.0)[0][0], [[0.9, 2.0 - 0.22]])


def test_backprop_preset_width():
    assert neural.backprop_preset(8).size == (8, 4, 1)


@pytest.fixture(scope="module")
def patterns(spark):
    data = [(i, [float(i % 2)], [float(i % 2)] * 3 + [float(1 - i % 2)] * 3) for i in range(300)]
    return spark.createDataFrame(data, "id bigint, label array<double>, features array<double>").repartition(4).persist()


def test_rbm_reduces_reconstruction_error(patterns):
    rbm = neural.rbm_train(patterns, hidden=4, batch_rows=300, epochs=30, momentum=0.5, alpha=0.5)
    assert rbm.W.shape == (4, 6) and rbm.errors[-1] < rbm.errors[0]
    again = neural.rbm_train(patterns.repartition(2), hidden=4, batch_rows=300, epochs=30, momentum=0.5, alpha=0.5)
    assert np.allclose(rbm.W, again.W)


def test_rbm_step_matches_numpy(patterns):
    rbm = neural.rbm_train(patterns, hidden=2, batch_rows=300, epochs=1, momentum=0.0, alpha=1.0, seed=7)
    rows = sorted(patterns.collect(), key=lambda r: r["id"])
    ids, v1 = np.array([r["id"] for r in rows]), np.array([r["features"] for r in rows])
    h1 = (0.5 > neural.uniforms(ids, 2, 7, 0, 0, 1)).astype(float)
    v2 = (0.5 > neural.uniforms(ids, 6, 7, 0, 0, 2)).astype(float)
    h2 = np.full((300, 2), 0.5)
    assert np.allclose(rbm.W, (h1.T @ v1 - h2.T @ v2) / 300)
    assert np.allclose(rbm.b, (v1 - v2).mean(axis=0)) and np.allclose(rbm.c, (h1 - h2).mean(axis=0))


def test_dbn_unfolds_into_a_network(patterns):
    layers = neural.dbn_train(patterns, [4, 3], batch_rows=300, epochs=5, momentum=0.5, alpha=0.5)
    cfg, weights = neural.dbn_to_net(layers, outputs=1, rate=1.0)
    assert cfg.size == (6, 4, 3, 1) and [w.shape for w in weights] == [(4, 7), (3, 5), (1, 4)]
    assert np.allclose(weights[0][:, 0], layers[0].c) and np.allclose(weights[0][:, 1:], layers[0].W)
    model = neural.net_train(patterns, cfg, batch_rows=300, epochs=10, initial=weights)
    assert model.history[-1]["train"] < model.history[0]["train"]


# ---- end-to-end jobs ------------------------------------------------------------------------------


def test_jobs_count_every_scored_row(spark, sf):
    base = views.base_feature_lines(spark, sf).persist()
    r = jobs.continuity_model(views.view_log(spark, sf), base, {"a": 20, "b": 20, "c": 20}).first()
    assert 0 < r["tp"] + r["fp"] + r["tn"] + r["fn"] < base.count()
    r = jobs.classic_model(base).first()
    assert r["tp"] + r["fp"] + r["tn"] + r["fn"] > 0 and 0 <= r["accuracy"] <= 1


def test_etl_commands(spark, tmp_path, rows):
    from stayline.sources import files

    source = tmp_path / "plays.txt"
    source.write_text("1\tguid=7&complete=1&play_types=net\n2\tguid=8&complete=0&play_types=net\n")
    for command, want in (("complete", [("7", 1)]), ("online", [("7", 1), ("8", 1)])):
        jobs.main([command, str(source), str(tmp_path / command)])
        assert rows(files.read_tuples(spark, str(tmp_path / command))) == want
