"""Matrices as tables: COO triples (i, j, v) and partial sums over vector columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.vectors import constant, dot
from stayline.operators import partials


def coo_build(entries: DataFrame) -> DataFrame:
    """Sum repeated cells; drop zero entries before and zero sums after."""
    return (
        entries.where(F.col("v") != 0).groupBy("i", "j").agg(F.sum("v").alias("v")).where(F.col("v") != 0)
    )


def coo_transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def coo_hconcat(left: DataFrame, right: DataFrame, left_cols: int) -> DataFrame:
    return left.select("i", "j", "v").unionByName(right.select("i", (F.col("j") + left_cols).alias("j"), "v"))


def coo_vconcat(top: DataFrame, bottom: DataFrame, top_rows: int) -> DataFrame:
    return top.select("i", "j", "v").unionByName(bottom.select((F.col("i") + top_rows).alias("i"), "j", "v"))


def coo_matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """a·b: join on the inner index, then one sum per cell (combined map-side).

    Both factors are built first, so the join sees one row per cell and repeated entries never multiply.
    """
    left = coo_build(a).select("i", F.col("j").alias("k"), F.col("v").alias("_a"))
    right = coo_build(b).select(F.col("i").alias("k"), "j", F.col("v").alias("_b"))
    return (
        left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v")).where(F.col("v") != 0)
    )


def coo_row_mean(m: DataFrame, n_cols: int | None = None) -> DataFrame:
    """Mean per row over its stored cells, or over ``n_cols`` when absent cells count as zero."""
    mean = F.avg("v") if n_cols is None else F.sum("v") / n_cols
    return m.groupBy("i").agg(mean.alias("mean"))


def coo_add_to_columns(m: DataFrame, vector: DataFrame) -> DataFrame:
    """Add vector (i, x) to every column: each stored cell (i, j) gains x_i."""
    return m.join(vector, "i").select("i", "j", (F.col("v") + F.col("x")).alias("v"))


def linear_score(df: DataFrame, x: str, weights: list[list[float]], keep: list[str]) -> DataFrame:
    """Rows of W·x as columns s0, s1, …; the weights are literals of the plan."""
    return df.select(*keep, *[dot(x, constant(w)).alias(f"s{k}") for k, w in enumerate(weights)])


def vector_sum(df: DataFrame, x: str) -> DataFrame:
    """Per position: total and count over all rows (position, total, n).

    Each task adds its vectors to one partial; partials meet in levels. Vectors may differ in length; nulls don't count.
    """

    def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        lists = batch.column(0)
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        position = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        there = ~lists.flatten().is_null().to_numpy(zero_copy_only=False)
        width = int(sizes.max(initial=0))
        weights = np.where(there, values, 0.0)
        return {"total": np.bincount(position, weights, width), "n": np.bincount(position, there, width)}

    def cell(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("values")))

    sums = partials.add_up(partials.partial_rows(df.select(F.col(x).cast("array<double>")), work), ["kind", "row"])
    both = sums.groupBy("row").agg(cell("total").alias("total"), cell("n").alias("n"))
    return both.select(F.posexplode(F.arrays_zip("total", "n")).alias("position", "cell")).where("cell.n > 0").select(
        "position", "cell.total", F.col("cell.n").cast("long").alias("n")
    )


def gram(df: DataFrame, x: str) -> DataFrame:
    """Upper triangle of XᵀX for a vector column of fixed width, as (i, j, v).

    Each task multiplies its Arrow batches and emits one partial matrix, so the shuffle carries
    width² cells per task however many rows there are.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            column = batch.column(0)
            if len(column) == 0:
                continue
            block = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            total = block.T @ block if total is None else total + block.T @ block
        if total is not None:
            i, j = np.triu_indices(total.shape[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"]
            )

    return (
        df.select(F.col(x).cast("array<double>").alias("x"))
        .where(F.col("x").isNotNull())
        .mapInArrow(partial, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
    )


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """mean, sample variance, non-zero count, max and min per column: one pass, one row per column."""
    aggs = []
    for c in columns:
        aggs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.avg(c).alias("mean"),
                F.var_samp(c).alias("variance"),
                F.count(F.when(F.col(c) != 0, 1)).alias("nonzero"),
                F.max(F.col(c).cast("double")).alias("max"),
                F.min(F.col(c).cast("double")).alias("min"),
            )
        )
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
