"""Model training and scoring on ``pyspark.ml``; each factory carries the settings the jobs use."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, classification, clustering, recommendation, regression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import shared_dir

# ratings of a block of ALS, about: a task holds those of its block and at most one factor of the other side for each
BLOCK_RATINGS = 2_000_000


def as_vectors(df: DataFrame, features: str = "features", nonnegative: bool = False) -> DataFrame:
    """array<double> → ML vector; ``nonnegative`` lifts values below 0 to 0 (naive Bayes needs that)."""
    x = F.col(features)
    if nonnegative:
        x = F.transform(x, lambda v: F.greatest(v, F.lit(0.0)))
    return df.withColumn(features, array_to_vector(x))


def fit(estimator: Estimator, df: DataFrame, key: str, partitions: int | None = None) -> Model:
    """Fit on a cached frame dealt by hash of the row key into ``partitions`` (the session's shuffle partitions), each in key order.

    Trainers run a job per step and draw by partition, so the number is a parameter: neither the row count nor the
    file layout changes the model.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cached = df.repartition(partitions, key).sortWithinPartitions(key).persist()
    try:
        return estimator.fit(cached)
    finally:
        cached.unpersist()


def fit_factors(estimator: recommendation.ALS, df: DataFrame, key: str, partitions: int | None = None) -> recommendation.ALSModel:
    """``fit`` with as many blocks as the ratings need, so that a task's memory doesn't grow with the table; the estimator's number at least.

    Factors are saved every three steps, since smaller blocks receive more copies of a factor and the shuffles of steps since then stay on disk.
    """
    shared_dir(df.sparkSession)  # without a checkpoint folder Spark saves nothing and keeps the shuffles of all steps

    class Sized:
        @staticmethod
        def fit(cached: DataFrame) -> recommendation.ALSModel:
            needed = math.ceil(cached.count() / BLOCK_RATINGS)
            users, items = (max(n, needed) for n in (estimator.getNumUserBlocks(), estimator.getNumItemBlocks()))
            blocks = {estimator.numUserBlocks: users, estimator.numItemBlocks: items, estimator.checkpointInterval: 3}
            return estimator.fit(cached, blocks)

    return fit(Sized, df, key, partitions)


def decision_tree(depth: int = 5, bins: int = 32, **kw) -> classification.DecisionTreeClassifier:
    return classification.DecisionTreeClassifier(impurity="gini", maxDepth=depth, maxBins=bins, seed=1, **kw)


def random_forest(trees: int = 20, depth: int = 10, bins: int = 20, **kw) -> classification.RandomForestClassifier:
    return classification.RandomForestClassifier(
        impurity="gini", numTrees=trees, maxDepth=depth, maxBins=bins, featureSubsetStrategy="auto", seed=1, **kw
    )


def boosted_trees(rounds: int = 20, depth: int = 10, **kw) -> classification.GBTClassifier:
    return classification.GBTClassifier(maxIter=rounds, maxDepth=depth, seed=1, **kw)


def naive_bayes(smoothing: float = 1.0, **kw) -> classification.NaiveBayes:
    return classification.NaiveBayes(modelType="multinomial", smoothing=smoothing, **kw)


def linear_svm(steps: int = 100, **kw) -> classification.LinearSVC:
    return classification.LinearSVC(maxIter=steps, **kw)


def logistic_regression(**kw) -> classification.LogisticRegression:
    return classification.LogisticRegression(family="auto", **kw)


def logistic_regression_lbfgs(steps: int = 20, tol: float = 1e-4, reg: float = 0.1, **kw) -> classification.LogisticRegression:
    """Explicit optimiser settings: 20 steps, tolerance 1e-4, L2 0.1."""
    return classification.LogisticRegression(maxIter=steps, tol=tol, regParam=reg, elasticNetParam=0.0, **kw)


def objective_history(model: classification.LogisticRegressionModel) -> DataFrame:
    spark = SparkSession.getActiveSession()
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "step int, loss double")


def linear_regression(**kw) -> regression.LinearRegression:
    return regression.LinearRegression(**kw)


def tree_regressor(depth: int = 5, bins: int = 100, **kw) -> regression.DecisionTreeRegressor:
    return regression.DecisionTreeRegressor(impurity="variance", maxDepth=depth, maxBins=bins, seed=1, **kw)


def kmeans(k: int = 2, steps: int = 20, **kw) -> clustering.KMeans:
    return clustering.KMeans(k=k, maxIter=steps, seed=1, **kw)


def als(rank: int = 10, steps: int = 20, reg: float = 0.01, **kw) -> recommendation.ALS:
    return recommendation.ALS(
        rank=rank, maxIter=steps, regParam=reg, userCol="user", itemCol="item", ratingCol="rating",
        coldStartStrategy="drop", seed=1, **kw,
    )


def als_implicit(rank: int = 10, steps: int = 20, reg: float = 0.001, alpha: float = 0.01, **kw) -> recommendation.ALS:
    return als(rank, steps, reg, implicitPrefs=True, alpha=alpha, **kw)


def multilayer_perceptron(layers: list[int], steps: int = 50, **kw) -> classification.MultilayerPerceptronClassifier:
    """Sigmoid layers with a softmax output; the fast path next to the network with all options."""
    return classification.MultilayerPerceptronClassifier(layers=layers, maxIter=steps, seed=1, **kw)


def text_stages(width: int = 1 << 18, steps: int = 10, reg: float = 0.01) -> Pipeline:
    """Tokenizer → hashed term frequencies → logistic regression over ``text`` and ``label``."""
    tokenizer = Tokenizer(inputCol="text", outputCol="words")
    hashing = HashingTF(inputCol="words", outputCol="features", numFeatures=width)
    return Pipeline(stages=[tokenizer, hashing, classification.LogisticRegression(maxIter=steps, regParam=reg)])


def naive_bayes_table(df: DataFrame, label: str, columns: list[str], smoothing: float = 1.0) -> list[dict]:
    """Multinomial naive Bayes from one aggregate: log-prior and log-likelihoods per class.

    One row per class comes back; ``naive_bayes_score`` turns the rows into column expressions.
    """
    sums = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.greatest(F.col(c), F.lit(0.0))).alias(c) for c in columns]
    ).collect()
    rows = sum(r["n"] for r in sums) + smoothing * len(sums)
    model = []
    for r in sorted(sums, key=lambda r: r["label"]):
        total = sum(r[c] or 0.0 for c in columns) + smoothing * len(columns)
        weights = {c: math.log((r[c] or 0.0) + smoothing) - math.log(total) for c in columns}
        model.append({"label": r["label"], "prior": math.log(r["n"] + smoothing) - math.log(rows), **weights})
    return model


def naive_bayes_score(df: DataFrame, rows: list[dict], columns: list[str]) -> DataFrame:
    """Add log joint per class (``s{label}``) and the label of the largest as ``prediction``."""
    scores = {}
    for r in rows:
        s = F.lit(float(r["prior"]))
        for c in columns:
            s = s + F.greatest(F.col(c), F.lit(0.0)) * F.lit(float(r[c]))
        scores[r["label"]] = s
    df = df.withColumns({f"s{label}": s for label, s in scores.items()})
    best = None
    for label in scores:
        others = [F.col(f"s{o}") for o in scores if o != label]
        wins = F.lit(True) if not others else (F.col(f"s{label}") >= (F.greatest(*others) if len(others) > 1 else others[0]))
        best = F.when(wins, F.lit(label)) if best is None else best.when(wins, F.lit(label))
    return df.withColumn("prediction", best)


def assign_nearest(df: DataFrame, x: str, centres: list[list[float]]) -> DataFrame:
    """Nearest of a few given centres: ``cluster`` (first of ties) and ``distance`` (squared)."""
    from stayline.functions.vectors import argmax, constant, sqdist

    distances = F.array(*[-sqdist(x, constant(c)) for c in centres])
    return (
        df.withColumn("_d", distances)
        .withColumns({"cluster": argmax("_d"), "distance": -F.array_max("_d")})
        .drop("_d")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
