"""Sums of arrays by key: each task sends one partial per key, and partials meet in levels of about √tasks each."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks get these functions with their closure, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# rows of an outgoing Arrow batch
OUT = 64


def plus(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Element-wise sum; the shorter array ends in zeros."""
    if a is None:
        return b.astype(float)
    if len(a) < len(b):
        a = np.concatenate([a, np.zeros(len(b) - len(a))])
    a[: len(b)] += b
    return a


def as_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def add_runs(rows: DataFrame, keys: list[str], values: str = "values") -> DataFrame:
    """One row for each run of rows with equal keys inside a partition; only the present sum is held."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"{', '.join(f'`{k}` {kinds[k]}' for k in keys)}, `{values}` array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.DataType] = []

        def runs() -> Iterator[tuple]:
            key, total = None, None
            for batch in batches:
                kept[:] = [c.type for c in batch.columns[:-1]]
                for i, own in enumerate(zip(*(c.to_pylist() for c in batch.columns[:-1]))):
                    if own != key and total is not None:
                        yield (*key, total)
                        total = None
                    key, total = own, plus(total, batch.column(len(keys))[i].values.to_numpy(zero_copy_only=False))
            if total is not None:
                yield (*key, total)

        held: list[tuple] = []
        for row in runs():
            held.append(row)
            if len(held) == OUT:
                yield _batch(held, pa.schema([*zip(keys, kept), (values, pa.list_(pa.float64()))]))
                held = []
        if held:
            yield _batch(held, pa.schema([*zip(keys, kept), (values, pa.list_(pa.float64()))]))

    return rows.select(*keys, F.col(values).cast("array<double>")).mapInArrow(add, out)


def add_up(rows: DataFrame, keys: list[str], values: str = "values", tasks: int | None = None) -> DataFrame:
    """Rows of equal keys added element by element: inside each task, then by groups of tasks, then all.

    However many tasks share a key, no task reads more than about √tasks partials of it. Rows with a null array don't count.
    """
    fan = math.ceil(math.sqrt(tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    near = add_runs(rows.where(F.col(values).isNotNull()).sortWithinPartitions(*keys), keys, values)
    group = near.withColumn("_group", F.spark_partition_id() % fan)
    middle = add_runs(group.repartition(*keys, "_group").sortWithinPartitions(*keys, "_group"), [*keys, "_group"], values).drop("_group")
    return add_runs(middle.repartition(*keys).sortWithinPartitions(*keys), keys, values)


def partial_rows(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, np.ndarray]]) -> DataFrame:
    """``kind, row, values``: the matrices that ``work`` gives for each Arrow batch, added inside the task, one row per matrix row."""
    schema = pa.schema([("kind", pa.string()), ("row", pa.int32()), ("values", pa.list_(pa.float64()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, m in work(batch).items() if batch.num_rows else ():
                m = np.atleast_2d(m)
                totals[name] = np.vstack([plus(a, b) for a, b in zip(totals[name], m)]) if name in totals else m.astype(float)
        yield from as_batches(((name, i, row) for name, m in totals.items() for i, row in enumerate(m)), schema)

    return df.mapInArrow(partial, "kind string, row int, values array<double>")


def summed(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The matrices of ``work`` added over all batches, on the driver, which adds the last √tasks partials of each row itself."""
    fan = math.ceil(math.sqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = partial_rows(df, work).withColumn("_group", F.spark_partition_id() % fan).repartition(fan, "kind", "row", "_group")
    found: dict[str, dict[int, np.ndarray]] = {}
    for r in add_runs(dealt.sortWithinPartitions("kind", "row"), ["kind", "row"]).collect():
        rows = found.setdefault(r["kind"], {})
        rows[r["row"]] = plus(rows.get(r["row"]), np.array(r["values"]))
    return {name: np.vstack([rows[i] for i in range(len(rows))]) for name, rows in found.items()}
