"""One-pass evaluation: confusion counts, rates, errors, area under ROC."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1) -> DataFrame:
    """tp, fp, tn, fn for the given positive class, in one aggregate."""
    y, p = F.col(label) == positive, F.col(prediction) == positive
    return df.agg(
        _count(y & p).alias("tp"), _count(~y & p).alias("fp"), _count(~y & ~p).alias("tn"), _count(y & ~p).alias("fn")
    )


def rates(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall and F1 from confusion counts; NULL where a divisor is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        "tp", "fp", "tn", "fn",
        F.try_divide((tp + tn).cast("double"), tp + fp + tn + fn).alias("accuracy"),
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"),
        F.try_divide(tp.cast("double"), tp + fn).alias("recall"),
        # 2pr/(p+r) in counts
        F.when(tp > 0, F.try_divide(2.0 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1) -> DataFrame:
    return rates(confusion(df, label, prediction, positive))


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    wrong = F.when(F.col(label) != F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(wrong).alias("error_rate"), F.count(F.lit(1)).alias("n"))


def squared_error(label: str, prediction: str) -> Column:
    d = F.col(prediction) - F.col(label)
    return d * d


def mse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg(squared_error(label, prediction)).alias("mse"), F.count(F.lit(1)).alias("n"))


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.sqrt(F.avg(squared_error(label, prediction))).alias("rmse"), F.count(F.lit(1)).alias("n"))


def half_mse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg((F.avg(squared_error(label, prediction)) * 0.5).alias("loss"), F.count(F.lit(1)).alias("n"))


def auc(df: DataFrame, label: str = "label", score: str = "score", positive: float = 1, buckets: int = 256) -> DataFrame:
    """Area under ROC by rank sum, ties counted half: one row (auc, n_pos, n_neg).

    Rows are first counted per distinct score, and the counts are written to the shared folder because three passes
    read them. The scores are cut into ranges of about equal size, the
    running count of negatives is a window inside each range plus the total of the ranges below, so no
    task sorts the whole table. At most ``buckets`` bounds and totals reach the driver. NULL where a
    class is empty.
    """
    y = F.col(label) == positive
    per_score = cut_lineage(
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(_count(y).alias("pos"), _count(~y).alias("neg"))
    )
    bounds = per_score.agg(F.percentile_approx("s", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []
    splits = [-float("inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) < 3:
        splits = [-float("inf"), 0.0, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="s", outputCol="_range", handleInvalid="keep").transform(per_score)
    ranged = ranged.withColumn("_range", F.col("_range").cast("int"))
    totals = {r["_range"]: r["neg"] for r in ranged.groupBy("_range").agg(F.sum("neg").alias("neg")).collect()}
    below, offsets = 0, []
    for i in range(len(splits)):
        offsets.append(below)
        below += totals.get(i, 0)
    w = Window.partitionBy("_range").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lower = F.sum("neg").over(w) - F.col("neg") + F.get(F.lit(offsets).cast("array<bigint>"), F.col("_range"))
    area = F.col("pos") * (lower + F.col("neg") * 0.5)
    sums = ranged.select("pos", "neg", area.alias("area")).agg(
        F.sum("area").alias("area"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    return sums.select(
        F.try_divide(F.col("area"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"), "n_pos", "n_neg"
    )


def nearest_cost(df: DataFrame, distance: str) -> DataFrame:
    """Within-set sum of squares from a column of squared distances to the assigned centre."""
    return df.agg(F.sum(distance).alias("cost"), F.count(F.lit(1)).alias("n"))
