"""Tables between the steps of an operator, kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayline import session


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet under ``spark.checkpoint.dir`` and read it back.

    Lost executors then cost no earlier step, and later steps read only the columns they use.
    """
    path = session.scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
