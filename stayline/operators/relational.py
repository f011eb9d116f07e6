"""Joins and pairings that hold up when one key owns a large share of the rows.

Inner joins are left to Spark: it broadcasts a side it has measured to be small and splits hot
partitions at run time. The forms below cover what that does not: full outer joins, cogroups, and
Cartesian products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import cut_lineage


def left_join_fill(left: DataFrame, right: DataFrame, on: list[str], fills: dict[str, float]) -> DataFrame:
    """Left outer join; unmatched rows get the default of each filled column."""
    return left.join(right, on, "left").fillna(fills)


def full_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join as a left join and the right rows without a partner.

    Spark splits a hot key of a left or anti join but not of a full outer join. The anti join sees the
    left side as distinct keys, so neither side is ever gathered whole in one task.
    """
    right_only = right.join(left.select(*on).distinct(), on, "left_anti")
    return left.join(right, on, "left").unionByName(right_only, allowMissingColumns=True)


def cogroup_values(left: DataFrame, right: DataFrame, on: str, left_value: str, right_value: str) -> DataFrame:
    """Both value bags per key in long form: key, side (left or right), value, n.

    Repeats are counted before the shuffle. The form is the same for every key, however many values it has, and no bag is gathered.
    """
    return (
        left.select(F.col(on).alias("key"), F.lit("left").alias("side"), F.col(left_value).alias("value"))
        .union(right.select(F.col(on).alias("key"), F.lit("right").alias("side"), F.col(right_value).alias("value")))
        .groupBy("key", "side", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cartesian(left: DataFrame, right: DataFrame, left_rows: int = 4_000, right_rows: int = 2_500) -> DataFrame:
    """Every left row with every right row, as an equi-join on a grid of cells.

    Rows are numbered, not hashed, so equal rows are spread as well; a cell joins ``left_rows`` with ``right_rows``
    rows, so its product is bounded however large the inputs are. A left row is copied once per block of right rows and the
    other way round, which is what a product of two tables costs.
    """
    def numbered(df: DataFrame, name: str, size: int) -> tuple[DataFrame, int]:
        # numbers run within hash partitions of a column-free kind: the scan order of each task
        placed = df.withColumn("_n", F.monotonically_increasing_id())
        staged = cut_lineage(placed)
        top = staged.groupBy(F.shiftright("_n", 33).alias("_p")).agg((F.max("_n").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_rows"))
        starts = top.withColumn("_start", F.coalesce(F.sum("_rows").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        total = top.agg(F.sum("_rows")).first()[0] or 0
        place = F.col("_start") + F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))
        # one row per task of the scan: small at any size
        rows = staged.withColumn("_p", F.shiftright("_n", 33)).join(F.broadcast(starts.select("_p", "_start")), "_p")
        return rows.select(*df.columns, F.floor(place / size).alias(name)), max(1, -(-total // size))

    a, n_left = numbered(left, "_i", left_rows)
    b, n_right = numbered(right, "_j", right_rows)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    return a.withColumn("_j", each(n_right)).join(b.withColumn("_i", each(n_left)), ["_i", "_j"]).drop("_i", "_j")


def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return df.withColumn(name, key)


def bag_union(*parts: DataFrame) -> DataFrame:
    """Union by name that keeps repeats; the same frame may appear twice."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
