"""File formats in and out: text, CSV, JSON lines, LibSVM, ratings, tuples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RATINGS = "user int, item int, rating float"


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV with a declared schema: no inference pass, and only the used columns are parsed."""
    return spark.read.schema(schema).csv(path, header=header)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATINGS).csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM file to label and a sparse vector; give the width to save a pass over the file."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def libsvm_line(label: Column | str, features: Column | str) -> Column:
    """``label 1:v 2:v …`` with zero entries left out."""
    label = F.col(label) if isinstance(label, str) else label
    features = F.col(features) if isinstance(features, str) else features
    entries = F.transform(
        features, lambda v, i: F.when(v != 0, F.concat((i + 1).cast("string"), F.lit(":"), v.cast("string")))
    )
    return F.concat_ws(" ", label.cast("string"), F.array_compact(entries))


def tsv_line(*columns: Column | str) -> Column:
    """Fields joined by tabs; NULL becomes the text ``NULL`` so that positions stay fixed."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("NULL")) for c in cols])


def write_tuples(df: DataFrame, path: str, key: str, value: str) -> None:
    """``(key,value)`` text lines."""
    line = F.concat(F.lit("("), F.col(key).cast("string"), F.lit(","), F.col(value).cast("string"), F.lit(")"))
    df.select(line.alias("value")).write.text(path)


def read_tuples(spark: SparkSession, path: str) -> DataFrame:
    """``(key,count)`` lines back to columns; the last comma splits."""
    pattern = "\\A\\((.*),([^,]*)\\)\\z"
    return spark.read.text(path).select(
        F.regexp_extract("value", pattern, 1).alias("key"),
        F.regexp_extract("value", pattern, 2).try_cast("bigint").alias("n"),
    )
