"""Word, page-view and user counts over file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators.logs import page_and_user_views, word_count
from stayline.session import scratch_path

PAGE_KEYS = ["page", "pos", "vid", "title"]


def run_append(stream: DataFrame, path: str, checkpoint: str | None = None) -> DataFrame:
    """Run what is available to the end, appending to a Parquet folder, and return that table."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_each_batch(stream: DataFrame, per_batch, path: str, checkpoint: str | None = None) -> DataFrame:
    """Apply ``per_batch`` to every micro-batch and keep each result under ``batch=<id>``.

    A batch that is repeated after a failure overwrites its own folder, so results are exact once.
    """
    spark = stream.sparkSession

    def sink(rows: DataFrame, batch_id: int) -> None:
        per_batch(rows).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # a stream without rows has no batch, but it has a schema
    none = per_batch(spark.createDataFrame([], stream.schema))
    none.write.mode("overwrite").parquet(f"{path}/batch=-1")
    schema = none.schema
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path)


def closed_windows(clicks: DataFrame, source, path: str, end: DataFrame) -> DataFrame:
    """All windows of a finite stream, the last ones too.

    ``source`` is a function from a folder to a stream over it. The clicks are put into a folder of their own and run to the end;
    then ``end``, a row later than every window, arrives as one more file, and a second run with the same state
    moves the watermark past all windows that are still open. The window of ``end`` itself stays open and is never shown.
    """
    folder, state = f"{path}-in", f"{path}-state"
    clicks.write.parquet(folder)
    run_append(windowed_page_views(source(folder), "1 day"), path, state)
    end.write.mode("append").parquet(folder)
    return run_append(windowed_page_views(source(folder), "1 day"), path, state)


def batch_word_counts(lines: DataFrame, column: str = "value", path: str | None = None) -> DataFrame:
    """word, n, batch: each micro-batch counted on its own."""
    path = path or scratch_path(lines.sparkSession, "word-counts")
    return run_each_batch(lines.select(column), lambda rows: word_count(rows, column), path)


def windowed_page_views(clicks: DataFrame, window: str = "1 minute", delay: str = "1 minute", user: str = "user_id") -> DataFrame:
    """pv and uv per window and page, for a stream (append mode) or a batch table.

    Two chained aggregations; a window is emitted when the watermark passes its end, which also frees
    its state.
    """
    if clicks.isStreaming:
        clicks = clicks.withWatermark("ts", delay)
    counts = page_and_user_views(clicks.withColumn("window", F.window("ts", window)), ["window", *PAGE_KEYS], user)
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *PAGE_KEYS, "pv", "uv"
    )


def top_pages(rows: DataFrame, n: int = 10, user: str = "user_id") -> DataFrame:
    """The n pages with most views, ties by key."""
    return page_and_user_views(rows, PAGE_KEYS, user).orderBy(F.desc("pv"), F.desc("uv"), *PAGE_KEYS).limit(n)


def batch_top_pages(clicks: DataFrame, n: int = 10, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The top pages of every micro-batch, with its batch id; runs that share a path and a checkpoint go on numbering."""
    path = path or scratch_path(clicks.sparkSession, "top-pages")
    return run_each_batch(clicks, lambda rows: top_pages(rows, n), path, checkpoint)
