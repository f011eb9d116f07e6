"""End-to-end jobs: log ETL and the two attrition models. ``python -m stayline.plans.jobs --help``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import session
from stayline.functions.encoding import encode_lines
from stayline.functions.strings import field, split_fields
from stayline.operators import episodes, features, logs, metrics, models, sampling
from stayline.sources import decode, files

# Training rows per class of the continuity model.
CLASS_SIZES = {"a": 48345, "b": 20093, "c": 17815}


def _with_class(lines: DataFrame) -> DataFrame:
    parts = split_fields("value")
    return lines.withColumns({"guid": field(parts, 0), "cls": field(parts, 1)})


def continuity_model(
    views: DataFrame, base_lines: DataFrame, sizes: dict[str, int] | None = None, split_seed: int = 11, sample_seed: int = 888,
    estimator: Estimator | None = None, scores: Callable[[DataFrame], DataFrame] = episodes.continuity_by_guid,
) -> DataFrame:
    """Views + base features → continuity → balanced sample → decision tree (or another estimator) → confusion and rates.

    ``scores`` gives guid and continuity of the views: by default from their show names; ``episodes.continuity_by_title`` reads shows from titles.

    One shuffle per aggregation level, one left join, and the balanced sample stays on the executors. The
    training frame (one row per user) is written to the shared folder once; sampling, training and scoring
    read it from there instead of running the view log again.
    """
    frame = session.cut_lineage(_with_class(features.train_frame(base_lines, scores(views))))
    train, test = sampling.random_split(frame.select("guid", "cls", "value", "continuity"), "guid", [0.6, 0.4], split_seed)
    balanced = sampling.sample_exact(train, "guid", "cls", sizes or CLASS_SIZES, sample_seed)
    points = models.as_vectors(features.train_points(balanced, "churn").where("n_bad = 0"))
    model = models.fit(estimator or models.decision_tree(depth=5, bins=32), points, "guid")
    scored = model.transform(models.as_vectors(features.train_points(test, "churn").where("n_bad = 0")))
    return metrics.binary_metrics(scored, positive=1)


def classic_points(lines: DataFrame) -> DataFrame:
    """Base feature lines → label (a = 1) and the eight numbers plus three ratios as one array."""
    rows = features.ratio_features(encode_lines(lines, "retained", key=True, drop_last=True).where("n_bad = 0"), ["guid"])
    names = [c for c in rows.columns if c not in ("guid", "label")]
    return rows.select("guid", "label", F.array(*names).alias("features"))


def _classic_halves(base_lines: DataFrame, split_seed: int, sample_seed: int) -> tuple[DataFrame, DataFrame]:
    """Balanced training points and test points: a 60/40 split, of the training rows 30 % of a, all b, c twice."""
    train, test = sampling.random_split(_with_class(base_lines), "guid", [0.6, 0.4], split_seed)
    balanced = sampling.rebalance(train, "guid", "cls", {"a": 0.3, "b": 1, "c": 2}, sample_seed)
    return classic_points(balanced), classic_points(test)


def classic_model(base_lines: DataFrame, split_seed: int = 11, sample_seed: int = 123, estimator: Estimator | None = None) -> DataFrame:
    """Base features → split and balanced sample → random forest (or another estimator) → confusion and rates.

    Label 0 (churned) is the positive class.
    """
    train, test = _classic_halves(base_lines, split_seed, sample_seed)
    model = models.fit(estimator or models.random_forest(trees=20, depth=10, bins=20), models.as_vectors(train), "guid")
    return metrics.binary_metrics(model.transform(models.as_vectors(test)), positive=0)


def classifiers() -> dict[str, tuple[Estimator, bool]]:
    """The classifiers of the comparison, and whether they need columns that aren't negative."""
    return {
        "decision_tree": (models.decision_tree(depth=5, bins=32), False), "random_forest": (models.random_forest(trees=20, depth=10, bins=20), False),
        "gbt": (models.boosted_trees(rounds=10, depth=5), False), "naive_bayes": (models.naive_bayes(), True),
        "svm": (models.linear_svm(steps=50), False), "logreg": (models.logistic_regression(), False),
    }


def compare_classifiers(base_lines: DataFrame, estimators: dict[str, tuple[Estimator, bool]] | None = None, split_seed: int = 11, sample_seed: int = 123) -> DataFrame:
    """Confusion and rates of every classifier on the same split: one row each, with its name as ``model``.

    Both halves are written once; every classifier trains and scores from there.
    """
    train, test = (session.cut_lineage(half) for half in _classic_halves(base_lines, split_seed, sample_seed))
    rows = None
    for name, (estimator, nonnegative) in (estimators or classifiers()).items():
        model = models.fit(estimator, models.as_vectors(train, nonnegative=nonnegative), "guid")
        scored = model.transform(models.as_vectors(test, nonnegative=nonnegative))
        part = metrics.binary_metrics(scored, positive=0).select(F.lit(name).alias("model"), "*")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def count_plays(spark: SparkSession, source: str, target: str, marker: str) -> None:
    """Play log → ``(guid,count)`` lines; one shuffle."""
    files.write_tuples(logs.plays_per_guid(decode.read_lines(spark, source), marker), target, "guid", "n")


def land_view_log(spark: SparkSession, source: str, target: str, channel: str) -> None:
    """Decode a view log once into Parquet, so that later jobs prune columns and push filters down."""
    decode.view_log(decode.read_lines(spark, source), channel=channel).write.parquet(target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("complete", "online"):
        p = commands.add_parser(name, help=f"count {name} plays per guid")
        p.add_argument("source")
        p.add_argument("target")
    p = commands.add_parser("land", help="decode a view log to Parquet")
    for arg in ("source", "target", "channel"):
        p.add_argument(arg)
    p = commands.add_parser("continuity", help="train and evaluate the continuity model")
    for arg in ("views", "base", "target"):
        p.add_argument(arg)
        if arg == "target":
            p.add_argument("--titles", action="store_true", help="read shows from titles")
    for name, what in (("classic", "train and evaluate the classic model"), ("compare", "train and evaluate all classifiers on one split")):
        p = commands.add_parser(name, help=what)
        for arg in ("base", "target"):
            p.add_argument(arg)
    args = parser.parse_args(argv)
    spark = session.build(f"stayline {args.command}")
    if args.command == "complete":
        count_plays(spark, args.source, args.target, "complete=1")
    elif args.command == "online":
        count_plays(spark, args.source, args.target, "play_types=net")
    elif args.command == "land":
        land_view_log(spark, args.source, args.target, args.channel)
    elif args.command == "continuity":
        scores = episodes.continuity_by_title if args.titles else episodes.continuity_by_guid
        continuity_model(spark.read.parquet(args.views), decode.read_lines(spark, args.base), scores=scores).write.parquet(args.target)
    elif args.command == "compare":
        compare_classifiers(decode.read_lines(spark, args.base)).write.parquet(args.target)
    else:
        classic_model(decode.read_lines(spark, args.base)).write.parquet(args.target)


if __name__ == "__main__":
    main()
