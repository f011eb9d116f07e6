"""Parquet table access, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file-source stream.

    The path is written as a glob so that one file and a folder of part files both work.
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file that appears in a folder (``value string``)."""
    return spark.readStream.text(path)


def register_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Temp views, for callers who write SQL."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def describe_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: table, position, column, type and the row count (a single aggregate)."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.explode(fields).alias("f"), "n_rows")
        .select(F.lit(name).alias("table_name"), "f.position", "f.column_name", "f.column_type", "n_rows")
    )
