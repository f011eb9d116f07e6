"""Queries over streams and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.plans.oracle_views import with_views
from stayline.plans.registry import query
from stayline.session import scratch_path
from stayline.sources import views
from stayline.sources.tables import table, table_stream
from stayline.streaming import counts

_DAYS = """select cast(date_trunc('day', ts) as string) as window_start, page, pos, vid, title, count(*) as pv, count(distinct user_id) as uv
    from clicks {where} group by 1, 2, 3, 4, 5"""


def _shown(windows):
    return windows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "page", "pos", "vid", "title", "pv", "uv")


@query("pv_uv", with_views("clicks", _DAYS.format(where="")))
def pv_uv(spark, sf_dir):
    clicks = views.page_clicks(table(spark, sf_dir, "events"))
    return _shown(counts.windowed_page_views(clicks, "1 day"))


@query("stream_pv_uv", with_views("clicks", _DAYS.format(where="")))
def stream_pv_uv(spark, sf_dir):
    """Row for row what ``pv_uv`` gives, from a stream."""
    clicks = views.page_clicks(table(spark, sf_dir, "events"))
    end = clicks.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.col("ts") + F.expr("interval 3 days"))
    source = lambda folder: spark.readStream.schema(clicks.schema).parquet(folder)
    return _shown(counts.closed_windows(clicks, source, scratch_path(spark, "pv-uv"), end))


@query("stream_word_count", """
    select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from documents) group by word""")
def stream_word_count(spark, sf_dir):
    per_batch = counts.batch_word_counts(table_stream(spark, sf_dir, "documents"), "text")
    return per_batch.groupBy("word").agg(F.sum("n").alias("n"))


@query("stream_top_pages", with_views("clicks", """
    select cast(event_id % 4 as int) as batch, page, pos, vid, title, count(*) as pv, count(distinct user_id) as uv from clicks group by 1, 2, 3, 4, 5
    qualify row_number() over (partition by batch order by count(*) desc, count(distinct user_id) desc, page, pos, vid, title) <= 10"""))
def stream_top_pages(spark, sf_dir):
    """A quarter of the clicks arrives before each of four runs with one state: four batches, each with its own top pages."""
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "top-pages")
    folder, state = f"{path}-in", f"{path}-state"
    for quarter in range(4):
        events.where(F.col("event_id") % 4 == quarter).write.mode("append").parquet(folder)
        clicks = views.page_clicks(spark.readStream.schema(events.schema).parquet(folder))
        tops = counts.batch_top_pages(clicks, path=path, checkpoint=state)
    return tops.select("batch", "page", "pos", "vid", "title", "pv", "uv")
