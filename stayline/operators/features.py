"""Model features: ratios, scaling, the training frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.encoding import encode_lines
from stayline.functions.scalars import guarded_ratio, hash_number
from stayline.functions.strings import split_fields
from stayline.operators.relational import left_join_fill


def ratio_features(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """Label and eight numbers plus three ratios of them.

    With f0 the label and f1…f8 the features: f6/f1, f6/f8 (0 below 0.001) and f6/(f7 + 1) (0 where
    f7 is -1).
    """
    f = {i: F.get("features", F.lit(i - 1)) for i in range(1, 9)}
    return encoded.select(
        *keep,
        "label",
        *[f[i].alias(f"f{i}") for i in f],
        guarded_ratio(f[6], f[1]).alias("f6_f1"),
        guarded_ratio(f[6], f[8]).alias("f6_f8"),
        F.coalesce(F.try_divide(f[6], f[7] + 1), F.lit(0.0)).alias("f6_f7"),
    )


def minmax_scale(df: DataFrame, columns: list[str], mode: str = "zero") -> DataFrame:
    """(x - min) / (max - min) per column from one aggregate; two numbers per column reach the driver.

    A constant column gives 0.0, or NaN with ``mode='nan'``.
    """
    row = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]).first()
    flat = F.lit(float("nan") if mode == "nan" else 0.0)

    def scaled(c: str):
        low, high = row[f"min_{c}"], row[f"max_{c}"]
        if low is None or high == low:
            return F.when(F.col(c).isNotNull(), flat)
        return (F.col(c) - F.lit(low)) / F.lit(high - low)

    return df.withColumns({c: scaled(c) for c in columns})


def train_frame(base_lines: DataFrame, continuity: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Base feature lines with the continuity score of their guid appended as the last feature.

    A guid without a score gets 0; rows with score 0 are dropped unless ``keep_zero``. The score table has
    one row per guid, so the join never multiplies rows.
    """
    base = base_lines.select(F.get(split_fields("value"), F.lit(0)).alias("guid"), "value")
    scores = continuity.select(F.col("guid").cast("string").alias("guid"), "continuity")
    joined = left_join_fill(base, scores, ["guid"], {"continuity": 0.0})
    return joined if keep_zero else joined.where(F.col("continuity") != 0)


def train_points(frame: DataFrame, preset: str = "churn") -> DataFrame:
    """guid, continuity, label, features (with the score last), n_bad from a training frame; the line's last field isn't a feature."""
    points = encode_lines(frame, preset, key=True, drop_last=True, keep=["continuity"])
    return points.withColumn("features", F.array_append("features", F.col("continuity").cast("double")))


def hashed_terms(df: DataFrame, key: str, words: str, width: int, seed: int | str = "tf") -> DataFrame:
    """``key, bucket, n``: how often each of ``width`` buckets occurs among the words of a row, by a hash any engine can repeat.

    The sparse rows of a document-term matrix; combined map-side, so a frequent bucket is one partial per row and task.
    """
    terms = df.select(key, F.explode(words).alias("term"))
    return terms.groupBy(key, (hash_number("term", seed) % width).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
