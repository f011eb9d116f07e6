"""Alternating least squares over rating blocks, with 64-bit ids and models as tables.

Ratings are written twice, dealt into blocks by user and by item. Each half step sends every factor once to each block that holds
one of its ratings (out-links), adds up normal equations inside the blocks (in-links) and solves them. The ratings of an id with more
than ``hot`` of them lie in several blocks; its partial equations meet as sums, so no task gathers a popular id.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import hash_number
from stayline.functions.vectors import dot
from stayline.operators.partials import add_runs, summed
from stayline.session import cut_lineage, scratch_path

# tasks get these functions with their closure, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ratings whose products are held at once
CHUNK = 1 << 14


@dataclass(frozen=True)
class Settings:
    rank: int = 10
    reg: float = 0.01  # times the number of ratings of the id
    alpha: float | None = None  # implicit feedback: confidence per unit of rating
    seed: int = 1
    block_rows: int = 1_000_000
    hot: int = 100_000


def blocks(ratings: DataFrame, settings: Settings, least: int) -> int:
    """So many blocks that one holds about ``block_rows`` ratings, whatever the table's size, and ``least`` at least."""
    return max(1, -(-ratings.count() // settings.block_rows), least)


class Links:
    """Ratings dealt into blocks by ``to``; ``sources`` says which blocks need the factor of which id."""

    def __init__(self, ratings: DataFrame, to: str, source: str, settings: Settings, blocks: int) -> None:
        spark = ratings.sparkSession
        rows = ratings.select(F.col(to).alias("to"), F.col(source).alias("source"), F.col("rating").cast("double").alias("rating"))
        hot = rows.groupBy("to").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > settings.hot)
        parts = hot.select("to", F.ceil(F.col("n") / settings.hot).alias("parts"))
        part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("source"), F.col("parts"))).otherwise(F.lit(0))
        dealt = rows.join(parts, "to", "left").select("to", "source", "rating", F.pmod(F.xxhash64("to", part), F.lit(blocks)).cast("int").alias("block"))
        self.name = f"links_{uuid.uuid4().hex}"
        dealt.repartition(blocks, "block").write.bucketBy(blocks, "block").option("path", scratch_path(spark, "links")).saveAsTable(self.name)
        self.ratings = spark.table(self.name)
        self.sources = cut_lineage(self.ratings.select("source", "block").distinct())

    def drop(self) -> None:
        self.ratings.sparkSession.sql(f"drop table {self.name}")


def initial(ids: DataFrame, settings: Settings) -> DataFrame:
    """``id, factors``: draws in [0, 1) over √rank that depend on id, seed and position only."""
    draw = lambda p: hash_number("id", f"{settings.seed}:{p}") / float(1 << 32) / settings.rank**0.5
    return ids.select("id", F.array(*[draw(p) for p in range(settings.rank)]).alias("factors"))


def normal_equations(links: Links, factors: DataFrame, settings: Settings) -> DataFrame:
    """``id, values`` per id of the other side: A row by row, then b, then the number of ratings that count."""
    rank, alpha = settings.rank, settings.alpha
    sent = links.sources.join(factors.withColumnRenamed("id", "source"), "source").select("block", "source", "factors")

    def equations(ratings: pa.Table, factors: pa.Table) -> pa.Table:
        if not ratings.num_rows or not factors.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "values": pa.array([], pa.list_(pa.float64()))})
        known = factors["source"].to_numpy()
        order = np.argsort(known)
        known, f = known[order], factors["factors"].combine_chunks().flatten().to_numpy().reshape(-1, rank)[order]
        to, source, r = (ratings[c].to_numpy() for c in ("to", "source", "rating"))
        ids, place = np.unique(to, return_inverse=True)
        values, met = np.zeros((len(ids), rank * rank + rank + 1)), np.zeros(len(ids), bool)
        for low in range(0, len(to), CHUNK):  # a few ratings at a time
            part = slice(low, low + CHUNK)
            at = np.minimum(np.searchsorted(known, source[part]), len(known) - 1)
            there = np.flatnonzero(known[at] == source[part])
            there = there[np.argsort(place[part][there], kind="stable")]
            if not len(there):
                continue
            own, starts = np.unique(place[part][there], return_index=True)
            x, y = f[at[there]], r[part][there]
            weight, goal, counted = np.ones_like(y), y, np.ones_like(y)
            if alpha is not None:
                weight, counted = alpha * np.abs(y), (y > 0).astype(float)
                goal = counted * (1.0 + weight)
            products = np.hstack([(x[:, :, None] * (weight[:, None] * x)[:, None, :]).reshape(len(y), -1), x * goal[:, None], counted[:, None]])
            values[own] += np.add.reduceat(products, starts)
            met[own] = True
        if not met.all():
            ids, values = ids[met], values[met]
        return pa.table({"id": ids, "values": pa.FixedSizeListArray.from_arrays(values.ravel(), values.shape[1]).cast(pa.list_(pa.float64()))})

    partial = links.ratings.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(equations, "id long, values array<double>")
    # an id meets as many rows as it has blocks
    return add_runs(partial.repartition("id").sortWithinPartitions("id"), ["id"])


def half_step(links: Links, factors: DataFrame, settings: Settings) -> DataFrame:
    """``id, factors`` of the side that ``links`` solve for, from the factors of the other side."""
    rank, reg = settings.rank, settings.reg
    base = np.zeros((rank, rank))
    if settings.alpha is not None:

        def squares(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            f = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
            return {"yty": f.T @ f}

        base = summed(factors.select("factors"), squares).get("yty", base)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            a = v[:, : rank * rank].reshape(-1, rank, rank) + base + reg * v[:, -1][:, None, None] * np.eye(rank)
            found = np.linalg.solve(a + 1e-12 * np.eye(rank) * (v[:, -1] == 0)[:, None, None], v[:, rank * rank : -1][:, :, None])[:, :, 0]
            factors = pa.FixedSizeListArray.from_arrays(found.ravel(), rank).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), factors], ["id", "factors"])

    return normal_equations(links, factors, settings).mapInArrow(solve, "id long, factors array<double>")


@dataclass
class Factors:
    """A model as two tables ``id, factors``."""

    users: DataFrame
    items: DataFrame
    settings: Settings

    def score(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """All columns of ``user, item, …`` and the predicted rating, null where user or item is unknown."""
        one = self.users.select(F.col("id").alias("_user"), F.col("factors").alias("_u"))
        two = self.items.select(F.col("id").alias("_item"), F.col("factors").alias("_v"))
        both = df.join(one, F.col("user") == F.col("_user"), "left").join(two, F.col("item") == F.col("_item"), "left")
        return both.withColumn(column, dot("_u", "_v")).drop("_user", "_u", "_item", "_v")

    def error(self, df: DataFrame) -> DataFrame:
        """Root mean squared error over the rows that can be scored: one row, ``rmse, n``."""
        off = F.col("rating") - F.col("prediction")
        return self.score(df).agg(F.sqrt(F.avg(off * off)).alias("rmse"), F.count("prediction").alias("n"))

    def save(self, path: str) -> None:
        """One folder: the factors of both sides, and the settings as a table of one row."""
        spark = self.users.sparkSession
        kinds = "version int, rank int, reg double, alpha double, seed int"
        s = self.settings
        spark.createDataFrame([(1, s.rank, s.reg, s.alpha, s.seed)], kinds).write.parquet(f"{path}/settings")
        self.users.write.parquet(f"{path}/users")
        self.items.write.parquet(f"{path}/items")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Factors:
        row = spark.read.parquet(f"{path}/settings").first()
        if row["version"] != 1:
            raise ValueError(f"factors of version {row['version']} at {path}")
        settings = Settings(row["rank"], row["reg"], row["alpha"], row["seed"])
        return Factors(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"), settings)


def train(ratings: DataFrame, settings: Settings = Settings(), sweeps: int = 10, start: DataFrame | None = None) -> Factors:
    """``user, item, rating`` (64-bit ids) to factors after ``sweeps`` of users, then items.

    Rows with a null id or rating don't count; repeated ratings count once each. ``start`` are item factors to begin with.
    """
    rows = ratings.where("user is not null and item is not null and rating is not null").select(
        F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item"), "rating"
    )
    n = blocks(rows, settings, int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by_user, by_item = Links(rows, "user", "item", settings, n), Links(rows, "item", "user", settings, n)
    items = start if start is not None else initial(rows.select(F.col("item").alias("id")).distinct(), settings)
    items, users = cut_lineage(items), None
    for _ in range(sweeps):
        users = cut_lineage(half_step(by_user, items, settings))
        items = cut_lineage(half_step(by_item, users, settings))
    if users is None:
        users = items.limit(0)
    by_user.drop()
    by_item.drop()
    return Factors(users, items, settings)
