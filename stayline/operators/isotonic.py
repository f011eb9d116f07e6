"""Isotonic regression over range partitions: the fit never meets in one task, whatever its number of blocks.

Pooling runs first inside each range partition of x. What is left are blocks in order, with prefix sums W of weights and S of
weighted values. For any level t the fit exceeds t from the place on where S - t·W is least, so one aggregate over the blocks
finds where a whole set of levels cuts the order, and both sides of a cut are independent. A range that its own mean doesn't cut is one block
of the solution, however many rows it has; a range of few blocks is pooled in one task; all others are cut again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage

# a cut counts if it gains more than the rounding of the sums
ROUNDING = 1e-12


def pool(sums: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pool adjacent violators: first index, sum and weight of each block; means rise from block to block."""
    starts = np.arange(len(sums))
    for _ in range(32):  # whole falling runs at once
        means = sums / weights
        heads = np.flatnonzero(np.concatenate([[True], means[1:] > means[:-1]])) if len(sums) else starts
        if len(heads) == len(sums):
            return starts, sums, weights
        starts, sums, weights = starts[heads], np.add.reduceat(sums, heads), np.add.reduceat(weights, heads)
    stack: list[list] = []  # what is left falls back block by block
    for block in zip(starts.tolist(), sums.tolist(), weights.tolist()):
        top = list(block)
        while stack and stack[-1][1] * top[2] >= top[1] * stack[-1][2]:
            before = stack.pop()
            top = [before[0], before[1] + top[1], before[2] + top[2]]
        stack.append(top)
    return tuple(np.array(c) for c in zip(*stack))


def points(df: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """Weighted means per distinct x (x, y, w). Rows with a null x or y, or a weight that isn't above 0, don't count."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & (w > 0))
        .groupBy(F.col(x).cast("double").alias("x"))
        .agg((F.sum(F.col(y) * w) / F.sum(w)).alias("y"), F.sum(w).alias("w"))
    )


def _placed(df: DataFrame, partitions: int | None) -> DataFrame:
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(partitions, "x").sortWithinPartitions("x")


def _pooled_parts(rows: DataFrame) -> DataFrame:
    """x, y, w with the number of the range partition and of the block inside it."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        x, y, w = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(3))
        starts, _, _ = pool(y * w, w)
        block = np.zeros(len(x), np.int64)
        block[starts[1:]] = 1
        part = np.full(len(x), TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (x, y, w, part, np.cumsum(block))], ["x", "y", "w", "part", "block"])

    return rows.select("x", "y", "w").mapInArrow(number, "x double, y double, w double, part int, block long")


def _in_order(rows: DataFrame) -> DataFrame:
    """Blocks (part, block, w, s) with their position and prefix sums over all parts; one row per part reaches the driver."""
    blocks = rows.groupBy("part", "block").agg(F.sum("w").alias("w"), F.sum(F.col("y") * F.col("w")).alias("s"))
    before, n, w, s = [], 0, 0.0, 0.0
    for r in blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum("s").alias("s")).orderBy("part").collect():
        before.append((r["part"], n, w, s))
        n, w, s = n + r["n"], w + r["w"], s + r["s"]
    offsets = rows.sparkSession.createDataFrame(before, "part int, n0 long, w0 double, s0 double")
    upto = Window.partitionBy("part").orderBy("block")
    return blocks.join(F.broadcast(offsets), "part").select(
        "part", "block", "w", "s", (F.col("n0") + F.row_number().over(upto) - 1).alias("pos"),
        (F.col("w0") + F.sum("w").over(upto)).alias("upto_w"), (F.col("s0") + F.sum("s").over(upto)).alias("upto_s"), F.lit(0).cast("long").alias("range"),
    )


def _pool_ranges(blocks: DataFrame) -> DataFrame:
    """Ranges of few blocks, each pooled in one task: part, block, fit."""

    def solve(table: pa.Table) -> pa.Table:
        order = np.argsort(table["pos"].to_numpy())
        s, w = table["s"].to_numpy()[order], table["w"].to_numpy()[order]
        starts, sums, weights = pool(s, w)
        fit = np.empty(len(s))
        fit[order] = np.repeat(sums / weights, np.diff(np.append(starts, len(s))))
        return pa.table({"part": table["part"], "block": table["block"], "fit": fit})

    return blocks.select("range", "part", "block", "pos", "w", "s").groupBy("range").applyInArrow(solve, "part int, block long, fit double")


def _cut(blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Blocks of ranges with their levels: each in its new range, or with its fit if its range isn't cut any more."""
    levels = blocks.join(ranges, "range").select(
        "range", "pos", (F.col("upto_w") - F.col("w0")).alias("w"), (F.col("upto_s") - F.col("s0")).alias("s"), F.explode("levels").alias("level")
    )
    gain = F.struct((F.col("s") - F.col("level") * F.col("w")).alias("value"), "pos")
    least = levels.groupBy("range", "level").agg(F.min(gain).alias("least"))
    last = F.col("range") + F.col("n") - 1
    real = (F.col("least.value") < -ROUNDING * (F.abs("ts") + F.abs("level") * F.col("tw"))) & (F.col("least.pos") < last)
    cuts = least.join(ranges, "range").where(real).groupBy("range").agg(F.collect_set("least.pos").alias("cuts"))
    ahead = ranges.select("range", (F.col("ts") / F.col("tw")).alias("mean")).join(cuts, "range", "left")
    inside = F.coalesce(F.array_max(F.filter("cuts", lambda p: p < F.col("pos"))) + 1, F.col("range"))
    return blocks.join(ahead, "range").select(
        "part", "block", "w", "s", "pos", "upto_w", "upto_s", inside.alias("range"), F.when(F.col("cuts").isNull(), F.col("mean")).alias("fit")
    )


def fit(df: DataFrame, x: str, y: str, weight: str | None = None, partitions: int | None = None, most: int = 10_000, levels: int = 31) -> DataFrame:
    """x, y, w and fit, one row per distinct x.

    ``most`` blocks are pooled in one task at most; a round cuts each larger range at up to ``levels`` + 1 levels. Ties of x are one
    point; an empty table gives no rows.
    """
    rows = cut_lineage(_pooled_parts(_placed(points(df, x, y, weight), partitions)))
    active, done = cut_lineage(_in_order(rows)), []
    shares = [(i + 1) / (levels + 1) for i in range(levels)]
    while True:
        first = lambda c: F.min_by(c, "pos")
        ranges = cut_lineage(
            active.groupBy("range").agg(
                F.count(F.lit(1)).alias("n"), F.sum("w").alias("tw"), F.sum("s").alias("ts"), first(F.col("upto_w") - F.col("w")).alias("w0"),
                first(F.col("upto_s") - F.col("s")).alias("s0"), F.percentile_approx(F.col("s") / F.col("w"), shares, 100 * (levels + 1)).alias("levels"),
            ).withColumn("levels", F.array_distinct(F.array_append("levels", F.col("ts") / F.col("tw"))))
        )
        large = ranges.where(F.col("n") > most)
        done.append(_pool_ranges(active.join(ranges.where(F.col("n") <= most).select("range"), "range", "left_semi")))
        if large.isEmpty():
            break
        state = cut_lineage(_cut(active, large))
        done.append(state.where("fit is not null").select("part", "block", "fit"))
        active = state.where("fit is null").drop("fit")
    fits = reduce(DataFrame.unionByName, done)
    return rows.join(fits, ["part", "block"]).select("x", "y", "w", "fit")


def predict(fitted: DataFrame, df: DataFrame, x: str, partitions: int | None = None, column: str = "fit") -> DataFrame:
    """All columns of a frame and the fit at its ``x``: linear between the neighbouring x of the fit, constant outside, null for a null x.

    Distinct x of both tables are dealt by range once; the first and last known point of each range pass to its neighbours
    through the driver.
    """
    asked = df.where(F.col(x).isNotNull()).select(F.col(x).cast("double").alias("x")).distinct()
    both = asked.join(fitted.select("x", "fit"), "x", "full")
    rows = cut_lineage(_placed(both, partitions).withColumn("part", F.spark_partition_id()))
    known = F.when(F.col("fit").isNotNull(), F.struct("x", "fit"))
    ends = rows.groupBy("part").agg(F.min(known).alias("first"), F.max(known).alias("last")).orderBy("part").collect()
    before, after, held = {}, {}, None
    for r in ends:
        before[r["part"]], held = held, r["last"] or held
    held = None
    for r in reversed(ends):
        after[r["part"]], held = held, r["first"] or held
    outside = rows.sparkSession.createDataFrame(
        [(r["part"], *(before[r["part"]] or (None, None)), *(after[r["part"]] or (None, None))) for r in ends], "part int, x0 double, f0 double, x1 double, f1 double"
    )
    upto, onward = Window.partitionBy("part").orderBy("x"), Window.partitionBy("part").orderBy(F.desc("x"))
    left, right = F.max(known).over(upto), F.min(known).over(onward)
    found = rows.select("part", "x", "fit", left.alias("left"), right.alias("right")).join(F.broadcast(outside), "part")
    x0, f0 = F.coalesce("left.x", "x0"), F.coalesce("left.fit", "f0")
    x1, f1 = F.coalesce("right.x", "x1"), F.coalesce("right.fit", "f1")
    between = f0 + (f1 - f0) * (F.col("x") - x0) / (x1 - x0)
    value = F.coalesce("fit", F.when(x0.isNull(), f1).when(x1.isNull(), f0).otherwise(between))
    answers = found.select(F.col("x").alias("isotonic_x"), value.alias(column))
    return df.join(answers, F.col(x).cast("double") == F.col("isotonic_x"), "left").drop("isotonic_x")
