"""Log ETL: plays per guid, word counts, click counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.strings import strip


def plays_per_guid(lines: DataFrame, marker: str) -> DataFrame:
    """Count lines holding the marker per guid piece.

    The marker is a plain substring of the line. In each tab field that has an ``&``, every
    ``&``-piece that contains ``guid=`` gives one key: the piece without its first five characters.
    """
    fields = F.filter(F.split("value", "\t"), lambda t: t.contains("&"))
    pieces = F.flatten(F.transform(fields, lambda t: F.split(strip(t), "&")))
    return (
        lines.where(F.col("value").contains(marker))
        .select(F.explode(F.filter(pieces, lambda p: p.contains("guid="))).alias("piece"))
        .groupBy(F.expr("substring(piece, 6)").alias("guid"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_count(texts: DataFrame, column: str = "value", sep: str = " ") -> DataFrame:
    """Words between single separators over whole texts; the empty word counts like any other."""
    return (
        texts.select(F.explode(F.split(column, sep)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def page_and_user_views(clicks: DataFrame, keys: list[str], user: str = "user_id") -> DataFrame:
    """Page views and distinct users per key in one chain.

    Counting per (key, user) first keeps a page with a third of all clicks spread over its users;
    the second step only adds up. The same chain runs on a stream, where ``count_distinct`` does not.
    """
    return (
        clicks.groupBy(*keys, user)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.sum("_n").alias("pv"), F.count(F.lit(1)).alias("uv"))
    )
