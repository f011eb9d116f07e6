"""Splits, samples and class rebalancing as functions of (row key, seed).

Every draw is a hash of the row key, so it does not depend on partitioning and repeats after a lost
executor. The key must identify a row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.scalars import hash_number, share_limit
from stayline.session import cut_lineage


def with_split(df: DataFrame, key: str, weights: list[float], seed: int | str, name: str = "split") -> DataFrame:
    """Add the index of the split a row falls into; weights are normalised."""
    total, edge, edges = sum(weights), 0.0, []
    for w in weights[:-1]:
        edge += w / total
        edges.append(share_limit(edge))
    drawn = hash_number(key, seed)
    index = F.lit(0)
    for e in edges:
        index = index + F.when(drawn >= e, 1).otherwise(0)
    return df.withColumn(name, index.cast("int"))


def random_split(df: DataFrame, key: str, weights: list[float], seed: int | str) -> list[DataFrame]:
    tagged = with_split(df, key, weights, seed, "_split")
    return [tagged.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int | str) -> DataFrame:
    return df.where(hash_number(key, seed) < share_limit(fraction))


def sample_exact(df: DataFrame, key: str, class_col: str, sizes: dict[str, int], seed: int | str) -> DataFrame:
    """Exactly ``sizes[c]`` rows of each class c (all of a smaller class, none for 0): those with the lowest hash.

    No class is sorted. Two histograms of the 32-bit hash (65,536 cells each, per class) locate the
    cut-off hash, the few rows that share it give the cut-off key, and one filter over the rows does the
    rest. The passes before that filter read only the class and the key.
    """
    sizes = {c: n for c, n in sizes.items() if n > 0}
    if not sizes:
        return df.where(F.lit(False))
    wanted = F.create_map(*[x for c, n in sizes.items() for x in (F.lit(c), F.lit(n).cast("bigint"))])
    want = F.element_at(wanted, F.col(class_col))
    hashed = hash_number(key, seed)
    rows = df.where(F.col(class_col).isin(*sizes))
    narrow = rows.select(class_col, key, F.shiftright(hashed, 16).alias("_hi"), (hashed % 65536).alias("_lo"))

    def cut(cells: DataFrame, cell: str, before: Column) -> DataFrame:
        """Per class the first histogram cell where the running count reaches the wanted size."""
        w = Window.partitionBy(class_col).orderBy(cell)
        running = F.sum("_n").over(w) + before
        return (
            cells.select("*", (running - F.col("_n")).alias("_below"), running.alias("_reached"))
            .where((F.col("_reached") >= want) & (F.col("_below") < want))
            .drop("_reached", "_n")
        )

    count = F.count(F.lit(1)).alias("_n")
    high = cut(narrow.groupBy(class_col, "_hi").agg(count), "_hi", F.lit(0)).withColumnRenamed("_below", "_before")
    # high, low and last hold at most one row per class named in sizes: safe to broadcast at any scale
    low_cells = narrow.join(F.broadcast(high), [class_col, "_hi"]).groupBy(class_col, "_hi", "_before", "_lo").agg(count)
    low = cut(low_cells, "_lo", F.col("_before")).select(class_col, "_hi", "_lo", (want - F.col("_below")).alias("_left"))
    tie = Window.partitionBy(class_col).orderBy(key)
    last = (
        narrow.join(F.broadcast(low), [class_col, "_hi", "_lo"])
        .withColumn("_rn", F.row_number().over(tie))
        .where(F.col("_rn") == F.col("_left"))
        .select(class_col, (F.col("_hi") * 65536 + F.col("_lo")).alias("_cut"), F.col(key).alias("_last"))
    )
    below = F.col("_cut").isNull() | (hashed < F.col("_cut")) | ((hashed == F.col("_cut")) & (F.col(key) <= F.col("_last")))
    return rows.join(F.broadcast(last), class_col, "left").where(below).select(*df.columns)


def rebalance(df: DataFrame, key: str, class_col: str, rates: dict[str, float], seed: int | str) -> DataFrame:
    """Keep each class at its rate: the fractional part by hash, the whole part as copies.

    0.3 keeps 30 %, 1 keeps all, 2 keeps every row twice, 2.5 twice and half of them once more. Classes
    without a rate are kept once. ``copy`` numbers the copies from 1.
    """
    drawn = hash_number(key, seed)
    copies = F.lit(1)
    for c, rate in rates.items():
        whole, part = int(rate), share_limit(rate - int(rate))
        copies = F.when(F.col(class_col) == c, F.lit(whole) + F.when(drawn < part, 1).otherwise(0)).otherwise(copies)
    return (
        df.withColumn("_copies", copies)
        .where(F.col("_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .drop("_copies")
    )


def with_fold(df: DataFrame, key: str, k: int, seed: int | str, name: str = "fold") -> DataFrame:
    return df.withColumn(name, (hash_number(key, seed) % k).cast("int"))


def folds(df: DataFrame, key: str, k: int, seed: int | str, swap: bool = False) -> list[tuple[DataFrame, DataFrame]]:
    """k (train, test) pairs; with ``swap`` one fold trains and the rest tests."""
    tagged = with_fold(df, key, k, seed, "_fold")
    pairs = []
    for i in range(k):
        rest, one = (tagged.where(c).drop("_fold") for c in (F.col("_fold") != i, F.col("_fold") == i))
        pairs.append((one, rest) if swap else (rest, one))
    return pairs


def ranked(df: DataFrame, key: str, name: str = "rank", partitions: int | None = None) -> tuple[DataFrame, int]:
    """All columns and the rank of the row in key order, from 0 and without gaps; and the number of rows.

    Rows are dealt by ranges of the key once; only one count per range passes through the driver. The key must identify a row.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    placed = cut_lineage(placed.withColumn("_part", F.spark_partition_id()))
    before, n = [], 0
    for r in placed.groupBy("_part").count().orderBy("_part").collect():
        before.append((r["_part"], n))
        n += r["count"]
    offsets = spark.createDataFrame(before, "_part int, _before long")
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return placed.withColumn("_nth", nth).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_nth") - 1).drop("_part", "_nth", "_before"), n


def permuted(rank: Column, n: int, seed: int | str, walks: int = 32) -> Column:
    """A permutation of 0 … n - 1: four Feistel rounds on a grid of about √n × √n; what falls outside is permuted again.

    The grid has fewer than √n places too many, so that a second walk is rare.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def rounds(v: Column) -> Column:
        left, right = F.floor(v / b).cast("long"), v % b
        left = (left + hash_number(right, f"{seed}:0")) % a
        right = (right + hash_number(left, f"{seed}:1")) % b
        left = (left + hash_number(right, f"{seed}:2")) % a
        right = (right + hash_number(left, f"{seed}:3")) % b
        return left * b + right

    again = lambda v, i: F.when((i > 0) & (v < n), v).otherwise(rounds(v))
    return F.aggregate(F.sequence(F.lit(0), F.lit(walks)), rank.cast("long"), lambda v, i: again(v, i))


def minibatches(df: DataFrame, key: str, size: int, seed: int | str, epoch: int = 0) -> DataFrame:
    """All columns with ``batch`` and ``place``: every row in one batch, each batch of exactly ``size`` rows but for the last.

    A draw without replacement: a row's place is a permutation of its rank, for each epoch another one.
    """
    rows, n = ranked(df, key, "_rank")
    at = rows.withColumn("_at", permuted(F.col("_rank"), n, f"{seed}:{epoch}"))
    return at.withColumns({"batch": F.floor(F.col("_at") / size).cast("long"), "place": F.col("_at") % size}).drop("_rank", "_at")
