"""Split search of decision trees as one aggregate per level: node, feature and bin to label sums, from which the best split follows.

A level brings at most nodes × features × bins rows together, whatever the number of rows; the splits of a level, one per node,
are a table that the next level joins. Nodes are numbered as in a heap: 1, then 2n and 2n + 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage


def width_bounds(df: DataFrame, features: str, width: int, bins: int) -> list[list[float]]:
    """``bins - 1`` bounds per feature at equal steps between its smallest and largest value: one pass."""
    ends = df.agg(*[f(F.get(features, F.lit(i))).alias(f"{n}{i}") for i in range(width) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    steps = []
    for i in range(width):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        steps.append([] if lo is None or lo == hi else [lo + (hi - lo) * b / bins for b in range(1, bins)])
    return steps


def quantile_bounds(df: DataFrame, features: str, width: int, bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Distinct bounds per feature at (approximately) equal shares of the rows."""
    shares = [b / bins for b in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.get(features, F.lit(i)), shares, accuracy).alias(f"q{i}") for i in range(width)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(width)]


def _sums(classes: int | None) -> dict[str, Column]:
    """What a bin adds up: rows per class, or rows, labels and squared labels."""
    y = F.col("label")
    if classes is None:
        return {"s0": F.count(y).cast("double"), "s1": F.sum(y.cast("double")), "s2": F.sum(y.cast("double") * y)}
    return {f"s{c}": F.count(F.when(y == c, 1)).cast("double") for c in range(classes)}


def _spread(sums: list[Column], classes: int | None) -> tuple[Column, Column]:
    """Rows, and rows times impurity (Gini or variance)."""
    if classes is None:
        n, s, q = sums
        return n, F.when(n > 0, q - s * s / n).otherwise(0.0)
    n = reduce(lambda a, b: a + b, sums)
    squares = reduce(lambda a, b: a + b, [s * s for s in sums])
    return n, F.when(n > 0, n - squares / n).otherwise(0.0)


def best_splits(rows: DataFrame, features: str, bounds: list[list[float]], classes: int | None = 2, least_rows: int = 1, least_gain: float = 1e-12) -> DataFrame:
    """``node, feature, threshold, gain, n, left_n`` per node that can be split; rows have ``node, label`` and an array of features.

    The gain is the fall of impurity per row. Rows up to the threshold go left. Of equal gains the smaller feature and bound
    wins. ``classes`` None is regression. A null or NaN value lies right of all bounds.
    """
    sums = _sums(classes)
    names = list(sums)
    limits = F.array(*[F.array(*[F.lit(float(b)) for b in bs]).cast("array<double>") for bs in bounds])
    each = rows.select("node", "label", F.posexplode(F.slice(features, 1, len(bounds))).alias("feature", "value"), limits.alias("limits"))
    own = F.get("limits", F.col("feature"))
    bin_of = F.when(F.col("value").isNull(), F.size(own)).otherwise(F.size(F.filter(own, lambda b: b < F.col("value"))))
    table = each.groupBy("node", "feature", bin_of.alias("bin")).agg(*[c.alias(n) for n, c in sums.items()])
    inside = Window.partitionBy("node", "feature")
    upto = inside.orderBy("bin")
    left = [F.sum(n).over(upto).alias(f"l{n}") for n in names]
    whole = [F.sum(n).over(inside).alias(f"w{n}") for n in names]
    swept = table.select("node", "feature", "bin", *left, *whole)
    ln, limp = _spread([F.col(f"l{n}") for n in names], classes)
    wn, wimp = _spread([F.col(f"w{n}") for n in names], classes)
    rn, rimp = _spread([F.col(f"w{n}") - F.col(f"l{n}") for n in names], classes)
    gains = swept.select("node", "feature", "bin", ((wimp - limp - rimp) / wn).alias("gain"), wn.alias("n"), ln.alias("left_n"), rn.alias("right_n"))
    allowed = gains.where((F.col("left_n") >= least_rows) & (F.col("right_n") >= least_rows) & (F.col("gain") > least_gain))
    best = allowed.groupBy("node").agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "n", "left_n")).alias("best"))
    at = best.select("node", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"), "best.gain", F.col("best.n").cast("long").alias("n"), F.col("best.left_n").cast("long").alias("left_n"), limits.alias("limits"))
    return at.select("node", "feature", F.get(F.get("limits", F.col("feature")), F.col("bin")).alias("threshold"), "gain", "n", "left_n")


def descend(rows: DataFrame, features: str, splits: DataFrame) -> DataFrame:
    """Each row in the child of its node; rows of nodes without a split stay. ``splits`` has at most one row per node."""
    value = F.get(features, F.col("feature"))
    right = F.when(value.isNull() | (value > F.col("threshold")), 1).otherwise(0)
    found = rows.join(F.broadcast(splits.select("node", "feature", "threshold")), "node", "left")
    return found.withColumn("node", F.when(F.col("threshold").isNull(), F.col("node")).otherwise(2 * F.col("node") + right)).drop("feature", "threshold")


def grow(df: DataFrame, label: str, features: str, bounds: list[list[float]], depth: int, classes: int | None = 2, least_rows: int = 1, least_gain: float = 1e-12) -> DataFrame:
    """The splits of a tree of up to ``depth`` levels (``level`` from 1); a level reads the table once."""
    start = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(label).alias("label"), F.col(features).alias("x"))
    found: list[DataFrame] = []
    for level in range(1, depth + 1):
        rows = start.withColumn("node", F.lit(1).cast("long"))
        for above in found:
            rows = descend(rows, "x", above)
        # only nodes of the last level can still be split
        rows = rows.where(F.col("node") >= 2 ** (level - 1))
        splits = cut_lineage(best_splits(rows, "x", bounds, classes, least_rows, least_gain).withColumn("level", F.lit(level)))
        if splits.isEmpty():
            break
        found.append(splits)
    empty = "node long, feature int, threshold double, gain double, n long, left_n long, level int"
    return reduce(DataFrame.unionByName, found) if found else df.sparkSession.createDataFrame([], empty)


def leaves(df: DataFrame, features: str, splits: DataFrame, depth: int) -> DataFrame:
    """All columns of a frame and the ``node`` of its leaf in a grown tree."""
    rows = df.withColumn("node", F.lit(1).cast("long"))
    for level in range(1, depth + 1):
        rows = descend(rows, features, splits.where(F.col("level") == level))
    return rows
