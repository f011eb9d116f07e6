"""K-means as sums over the table: a start drawn in a few passes, then rounds that add up one partial per task.

Centres are k rows of the driver; what a round brings back is their sums, sizes and costs.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import hash_number
from stayline.operators.partials import summed

# tasks get these functions with their closure, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (the first of ties) and the squared distance, one centre at a time."""
    best, at = np.full(len(x), np.inf), np.zeros(len(x), int)
    for k, c in enumerate(centres):
        far = ((x - c) ** 2).sum(axis=1)
        wins = far < best
        best[wins], at[wins] = far[wins], k
    return at, best


def _round(df: DataFrame, x: str, centres: np.ndarray) -> np.ndarray:
    """Per centre: the sum of its vectors, their number, their cost."""

    def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        v = _rows(batch)
        at, far = nearest(v, centres)
        total = np.zeros((len(centres), v.shape[1] + 2))
        np.add.at(total, at, np.column_stack([v, np.ones(len(v)), far]))
        return {"total": total}

    rows = df.where(F.col(x).isNotNull()).select(F.col(x).cast("array<double>"))
    return summed(rows, work).get("total", np.zeros((len(centres), centres.shape[1] + 2)))


@dataclass
class Clusters:
    centres: np.ndarray
    sizes: np.ndarray  # rows nearest to each centre
    costs: np.ndarray  # their squared distances
    history: list[float] = field(default_factory=list)  # the whole cost before each round, and at the end

    @property
    def cost(self) -> float:
        return float(self.costs.sum())

    def table(self, spark: SparkSession) -> DataFrame:
        """``cluster, centre, n, cost``."""
        rows = [(k, list(map(float, c)), int(n), float(e)) for k, (c, n, e) in enumerate(zip(self.centres, self.sizes, self.costs))]
        return spark.createDataFrame(rows, "cluster int, centre array<double>, n long, cost double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).withColumn("version", F.lit(1)).coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Clusters:
        rows = spark.read.parquet(path).orderBy("cluster").collect()
        if any(r["version"] != 1 for r in rows):
            raise ValueError(f"centres of another version at {path}")
        return Clusters(*(np.array([r[c] for r in rows]) for c in ("centre", "n", "cost")))

    def assign(self, df: DataFrame, x: str) -> DataFrame:
        """All columns and ``cluster``, ``distance`` (squared); null for a null vector."""
        centres = self.centres

        def find(v: pa.Array) -> pa.Array:
            there = ~v.is_null().to_numpy(zero_copy_only=False)
            known = v.drop_null()
            at, far = nearest(known.flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1), centres) if len(known) else ([], [])
            cluster, distance = np.zeros(len(v), np.int32), np.zeros(len(v))
            cluster[there], distance[there] = at, far
            return pa.StructArray.from_arrays([pa.array(cluster, mask=~there), pa.array(distance, mask=~there)], ["cluster", "distance"])

        found = F.arrow_udf(find, "struct<cluster: int, distance: double>").asNondeterministic()
        taken = "_found"
        while taken in df.columns:
            taken += "_"
        wide = df.withColumn(taken, found(F.col(x).cast("array<double>")))
        return wide.withColumns({"cluster": F.col(f"{taken}.cluster"), "distance": F.col(f"{taken}.distance")}).drop(taken)


def lloyd(df: DataFrame, x: str, centres: np.ndarray, rounds: int, tolerance: float = 0.0) -> Clusters:
    """Up to ``rounds`` moves of the centres to the means of their rows; a centre without rows stays.

    Ends early once no centre moves by more than the tolerance (squared distance). Null vectors don't count.
    """
    centres, history = np.array(centres, float), []
    for _ in range(rounds):
        total = _round(df, x, centres)
        history.append(float(total[:, -1].sum()))
        n = total[:, -2:-1]
        after = np.where(n > 0, total[:, :-2] / np.maximum(n, 1), centres)
        still = float(((after - centres) ** 2).sum(axis=1).max(initial=0)) <= tolerance
        centres = after
        if still:
            break
    total = _round(df, x, centres)
    return Clusters(centres, total[:, -2].astype(np.int64), total[:, -1], [*history, float(total[:, -1].sum())])


def start(df: DataFrame, x: str, key: str, k: int, passes: int = 4, oversample: float = 2.0, seed: int = 1) -> np.ndarray:
    """``k`` centres by oversampling: each pass takes a row with a chance of ``oversample · k`` times its share of the cost.

    About ``passes · oversample · k`` rows reach the driver; weighted by the rows nearest to them, k of them are chosen one after the
    other, again by cost. Draws depend on key, seed and pass, so any partitioning gives the same start. Fewer distinct rows than k give
    fewer centres.
    """
    rows = df.where(F.col(x).isNotNull()).select(F.col(key).alias("key"), F.col(x).cast("array<double>").alias("x"))
    first = rows.orderBy(hash_number("key", seed), "key").limit(1).collect()
    if not first:
        return np.empty((0, 0))
    found = np.array([first[0]["x"]])
    for n in range(passes):
        here = Clusters(found, np.zeros(len(found)), np.zeros(len(found))).assign(rows, "x")
        cost = here.agg(F.sum("distance")).first()[0]
        if not cost:
            break
        draw = hash_number("key", f"{seed}:{n}") / float(1 << 32)
        taken = here.where(draw < F.col("distance") * (oversample * k / cost)).select("key", "x").orderBy("key").collect()
        found = np.unique(np.vstack([found, *([r["x"]] for r in taken)]), axis=0)
    weights, choose = _round(rows, "x", found)[:, -2], np.random.default_rng(seed)
    chosen = [int(choose.choice(len(found), p=weights / weights.sum()))]
    while len(chosen) < min(k, len(found)):
        share = weights * nearest(found, found[chosen])[1]
        if not share.sum():
            break
        chosen.append(int(choose.choice(len(found), p=share / share.sum())))
    return found[chosen]


def fit(df: DataFrame, x: str, key: str, k: int, rounds: int = 20, seed: int = 1, tolerance: float = 1e-8) -> Clusters:
    centres = start(df, x, key, k, seed=seed)
    return lloyd(df, x, centres, rounds, tolerance) if len(centres) else Clusters(centres, np.empty(0), np.empty(0))
