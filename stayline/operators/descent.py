"""Full-batch gradient loops: linear, logistic, hinge and multinomial losses.

The columns are written to shared storage once; every step is one aggregate over them: the current weights are literals of
the plan, the loss and one sum per weight come back. The source is scanned once, and nothing but those sums reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import sigmoid
from stayline.session import cut_lineage


@dataclass
class Fit:
    weights: list[float]
    history: list[float]  # loss at the start of each step

    def weight_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.weights)), "position int, weight double")

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i + 1, v) for i, v in enumerate(self.history)], "step int, loss double")


def score(columns: list[str], weights: list[float]) -> Column:
    total = F.lit(0.0)
    for c, w in zip(columns, weights):
        total = total + F.col(c) * F.lit(float(w))
    return total


def _sums(df: DataFrame, columns: list[str], factor: Column, loss: Column) -> tuple[list[float], float, int]:
    """Σ factor·x per column, Σ loss and the row count, in one pass."""
    rows = df.select(*columns, factor.alias("_f"), loss.alias("_l"))
    row = rows.agg(
        *[F.sum(F.col("_f") * F.col(c)).alias(f"g{j}") for j, c in enumerate(columns)],
        F.sum("_l").alias("loss"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return [row[f"g{j}"] or 0.0 for j in range(len(columns))], row["loss"] or 0.0, row["n"]


def _once(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """The columns of the loop as numbers, so that no step runs the source again."""
    return cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*columns, label])]))


def linear(df: DataFrame, columns: list[str], label: str, steps: int, step: float, decay: bool = True, stop_loss: float | None = None) -> Fit:
    """w ← w - (step/√t)·mean((w·x - y)·x), started at 0; the loss is ½·mean(w·x - y)²."""
    df, w, history = _once(df, columns, label), [0.0] * len(columns), []
    for t in range(1, steps + 1):
        error = score(columns, w) - F.col(label)
        grads, loss, n = _sums(df, columns, error, error * error)
        if n == 0:
            break
        history.append(0.5 * loss / n)
        if stop_loss is not None and history[-1] <= stop_loss:
            break
        rate = step / math.sqrt(t) if decay else step
        w = [a - rate * g / n for a, g in zip(w, grads)]
    return Fit(w, history)


def logistic(df: DataFrame, columns: list[str], label: str, steps: int, rate: float) -> Fit:
    """w ← w + rate·mean((y - σ(w·x))·x); the loss is the mean log loss."""
    df, w, history = _once(df, columns, label), [0.0] * len(columns), []
    for _ in range(steps):
        z = score(columns, w)
        p, y = sigmoid(z), F.col(label)
        loss = F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - y * z
        grads, total, n = _sums(df, columns, y - p, loss)
        if n == 0:
            break
        history.append(total / n)
        w = [a + rate * g / n for a, g in zip(w, grads)]
    return Fit(w, history)


def svm_l1(df: DataFrame, columns: list[str], label: str, steps: int = 200, step: float = 1.0, reg: float = 0.1) -> Fit:
    """Hinge subgradient with step/√t and a soft threshold by reg·step after each move; labels 0/1."""
    df, w, history = _once(df, columns, label), [0.0] * len(columns), []
    for t in range(1, steps + 1):
        sign = F.col(label) * 2.0 - 1.0
        margin = sign * score(columns, w)
        active = margin < 1
        grads, loss, n = _sums(
            df, columns, F.when(active, -sign).otherwise(0.0), F.when(active, 1.0 - margin).otherwise(0.0)
        )
        if n == 0:
            break
        history.append(loss / n + reg * sum(abs(v) for v in w))
        rate = step / math.sqrt(t)
        moved = [a - rate * g / n for a, g in zip(w, grads)]
        w = [math.copysign(max(abs(a) - reg * rate, 0.0), a) for a in moved]
    return Fit(w, history)


def multinomial_loss(df: DataFrame, columns: list[str], label: str, weights: list[list[float]]) -> DataFrame:
    """Summed multinomial logistic loss and gradient at the given weights of classes 1…k-1 (class 0 is the pivot).

    One row: loss, n and g{class}_{position}. Margins are shifted by their maximum so that no
    exponential overflows.
    """
    y = F.col(label)
    margins = [f"_m{i}" for i in range(1, len(weights) + 1)]
    df = df.select(*columns, label, *[score(columns, w).alias(m) for m, w in zip(margins, weights)])
    top = F.greatest(F.lit(0.0), *[F.col(m) for m in margins])
    df = df.withColumn("_top", top)
    z = F.exp(-F.col("_top"))
    for m in margins:
        z = z + F.exp(F.col(m) - F.col("_top"))
    df = df.withColumn("_z", z)
    own = F.lit(0.0)
    for i, m in enumerate(margins, 1):
        own = F.when(y == i, F.col(m)).otherwise(own)
    aggs = [F.sum(F.col("_top") + F.log("_z") - own).alias("loss"), F.count(F.lit(1)).alias("n")]
    for i, m in enumerate(margins, 1):
        factor = F.exp(F.col(m) - F.col("_top")) / F.col("_z") - F.when(y == i, 1.0).otherwise(0.0)
        aggs += [F.sum(factor * F.col(c)).alias(f"g{i}_{j}") for j, c in enumerate(columns)]
    return df.agg(*aggs)
