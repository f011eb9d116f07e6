"""PageRank over an edge table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import cut_lineage, scratch_path

RESET, DAMPING = 0.15, 0.85  # fixed values


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    rounds: int | None = None,
    tolerance: float = 0.001,
    checkpoint_every: int = 5,
    hot_degree: int = 1_000_000,
    buckets: int | None = None,
    max_rounds: int = 200,
) -> DataFrame:
    """id, rank with rank ← 0.15 + 0.85·Σ rank_src / outdeg_src, started at 1.

    Runs a fixed number of rounds, or until a round moves no rank by more than the tolerance (looked at every
    ``checkpoint_every`` rounds, when the ranks are cut to the shared folder).

    Vertices and edges are written once, bucketed by id and by (src, salt), so a round shuffles only shares
    and their sums per target, never the edges. ``buckets`` has no upper bound (by default the session's shuffle
    partitions). A source with more than ``hot_degree`` edges is spread over several salts and its share copied to each, so no
    bucket holds a hot source whole. Shares are summed per target map-side before they shuffle. With a tolerance, ranks that
    haven't settled after ``max_rounds`` are an error. The two tables leave the catalogue before the ranks are returned.
    """
    spark = edges.sparkSession
    edges = edges.select("src", "dst").persist()  # read three times below, not in the rounds
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = []

    def placed(df: DataFrame, label: str, *keys: str) -> DataFrame:
        """Write bucketed by the keys, so that joins on them read without a shuffle."""
        name = f"{label}_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
        writer.option("path", scratch_path(spark, label)).saveAsTable(name)
        tables.append(name)
        return spark.table(name)

    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    salts = F.ceil(F.col("degree") / hot_degree).cast("int")
    nodes = placed(
        vertices.select("id").join(degree, "id", "left").select(
            "id", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce(salts, F.lit(0)).alias("salts")
        ),
        "vertices", "id",
    )
    hot = nodes.where(F.col("salts") > 1).select(F.col("id").alias("src"), "salts")
    salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")), F.lit(0)).cast("int")
    links = placed(edges.join(hot, "src", "left").select("src", "dst", salt.alias("salt")), "edges", "src", "salt")
    edges.unpersist()

    def step(now: DataFrame) -> DataFrame:
        shares = now.where(F.col("degree") > 0).select(
            F.col("id").alias("src"),
            (F.col("rank") / F.col("degree")).alias("share"),
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        )
        incoming = (
            links.join(shares, ["src", "salt"]).groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("incoming"))
        )
        rank = F.lit(RESET) + DAMPING * F.coalesce("incoming", F.lit(0.0))
        return nodes.join(incoming, "id", "left").select("id", "degree", "salts", rank.alias("rank"))

    state = nodes.withColumn("rank", F.lit(1.0))
    done, limit = 0, max_rounds if rounds is None else rounds
    while done < limit:
        ahead = min(checkpoint_every, limit - done)
        for _ in range(ahead - 1):
            state = step(state)
        done += ahead
        if rounds is not None:
            state = step(state)
            if done < limit:
                state = cut_lineage(state)
            continue
        before = cut_lineage(state)
        state = cut_lineage(step(before))
        earlier = before.select("id", F.col("rank").alias("earlier"))
        moved = state.join(earlier, "id").agg(F.max(F.abs(F.col("rank") - F.col("earlier")))).first()[0]
        if moved is None or moved <= tolerance:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"ranks still move by more than {tolerance} after {max_rounds} rounds")
    ranks = cut_lineage(state.select("id", "rank"))
    for name in tables:
        spark.sql(f"drop table {name}")
    return ranks


def top_ranked(vertices: DataFrame, ranks: DataFrame, k: int = 10) -> DataFrame:
    """The k vertices of highest rank with their titles; a vertex without a rank has 0."""
    return (
        vertices.join(ranks, "id", "left")
        .select("id", "title", F.coalesce("rank", F.lit(0.0)).alias("rank"))
        .orderBy(F.desc("rank"), "id")
        .limit(k)
    )
