"""Vector columns as array<double>: products, norms, distances, sparse form."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def constant(values) -> Column:
    """A small fixed vector (weights, a centre) as an array literal."""
    return F.array(*[F.lit(float(v)) for v in values])


def dot(x: Column | str, y: Column | str) -> Column:
    return _sum(F.zip_with(_c(x), _c(y), lambda a, b: a * b))


def scale(a: float | Column, x: Column | str) -> Column:
    return F.transform(_c(x), lambda v: v * a)


def combine(x: Column | str, y: Column | str, op: str) -> Column:
    """Element-wise add, sub, mul or div (0 where the divisor is 0)."""
    ops = {
        "add": lambda a, b: a + b,
        "sub": lambda a, b: a - b,
        "mul": lambda a, b: a * b,
        "div": lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0)),
    }
    return F.zip_with(_c(x), _c(y), ops[op])


def axpy(a: float, x: Column | str, y: Column | str) -> Column:
    """a·x + y."""
    return F.zip_with(_c(x), _c(y), lambda u, v: u * a + v)


def norm(x: Column | str, p: float) -> Column:
    if p < 1:
        raise ValueError("a norm needs p >= 1")
    if math.isinf(p):
        return F.array_max(F.transform(_c(x), lambda v: F.abs(v)))
    if p == 1:
        return _sum(F.transform(_c(x), lambda v: F.abs(v)))
    if p == 2:
        return F.sqrt(_sum(F.transform(_c(x), lambda v: v * v)))
    return F.pow(_sum(F.transform(_c(x), lambda v: F.pow(F.abs(v), F.lit(float(p))))), F.lit(1.0 / p))


def sqdist(x: Column | str, y: Column | str) -> Column:
    return _sum(F.zip_with(_c(x), _c(y), lambda a, b: (a - b) * (a - b)))


def argmax(x: Column | str) -> Column:
    """0-based position of the first maximum; -1 for an empty vector."""
    x = _c(x)
    return F.when(F.size(x) == 0, F.lit(-1)).otherwise((F.array_position(x, F.array_max(x)) - 1).cast("int"))


def count_nonzero(x: Column | str) -> Column:
    return F.size(F.filter(_c(x), lambda v: v != 0))


def to_sparse(x: Column | str) -> Column:
    """struct(size, indices, values) of the non-zero entries."""
    x = _c(x)
    kept = F.filter(F.transform(x, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
    return F.struct(
        F.size(x).alias("size"),
        F.transform(kept, lambda e: e["i"]).alias("indices"),
        F.transform(kept, lambda e: e["v"]).alias("values"),
    )


def to_dense(s: Column | str) -> Column:
    """Sparse struct back to a full array."""
    s = _c(s)
    lookup = F.map_from_arrays(s["indices"], s["values"])
    positions = F.when(s["size"] > 0, F.sequence(F.lit(0), s["size"] - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(positions, lambda i: F.coalesce(F.try_element_at(lookup, i), F.lit(0.0)))


def is_smaller_sparse(x: Column | str) -> Column:
    """True where the sparse form takes less room: 1.5·(nnz + 1) < size."""
    return F.lit(1.5) * (count_nonzero(x) + 1) < F.size(_c(x))


def append_bias(x: Column | str) -> Column:
    return F.concat(F.array(F.lit(1.0)), _c(x))


def from_pairs(pairs: DataFrame, key: str, size: int, index: str = "index", value: str = "value") -> DataFrame:
    """(key, index, value) rows → one sparse vector per key.

    A repeated index is reported in ``duplicates`` and an index outside 0…size-1 in ``out_of_range``.
    Rows are first reduced to one per (key, index), so a vector never holds more than ``size`` entries
    however many rows a key has.
    """
    inside = F.col(index).between(0, size - 1)
    cells = pairs.groupBy(key, index).agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v"))
    entry = F.when(inside, F.struct(F.col(index).alias("i"), F.col("_v").alias("v")))
    grouped = cells.groupBy(key).agg(
        F.sort_array(F.collect_list(entry)).alias("_e"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("out_of_range"),
    )
    return grouped.select(
        key,
        F.struct(
            F.lit(size).alias("size"),
            F.transform("_e", lambda e: e["i"]).alias("indices"),
            F.transform("_e", lambda e: e["v"]).alias("values"),
        ).alias("vector"),
        "duplicates",
        "out_of_range",
    )
