"""Streams against their batch twins."""

import json

from pyspark.sql import functions as F

from stayline.operators.logs import word_count
from stayline.session import scratch_path
from stayline.sources import views
from stayline.sources.tables import table, table_stream, text_stream
from stayline.streaming import counts


def test_closed_windows_equal_the_batch(spark, sf, rows):
    batch = counts.windowed_page_views(views.page_clicks(table(spark, sf, "events")), "1 day")
    stream = counts.run_append(
        counts.windowed_page_views(views.page_clicks(table_stream(spark, sf, "events")), "1 day"), scratch_path(spark, "t")
    )
    last = batch.agg(F.max("window_start")).first()[0]
    assert rows(stream) == rows(batch.where(F.col("window_start") < last))


def test_words_are_counted_per_batch(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    for i, text in enumerate(("a b a", "b c")):
        (tmp_path / "in" / f"{i}.txt").write_text(text)
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    per_batch = counts.batch_word_counts(lines)
    assert per_batch.select("batch").distinct().count() == 2
    total = per_batch.groupBy("word").agg(F.sum("n").alias("n"))
    assert rows(total) == rows(word_count(spark.read.text(str(tmp_path / "in"))))
    whole = counts.batch_word_counts(text_stream(spark, str(tmp_path / "in")))
    assert rows(whole.select("word", "n")) == [("a", 2), ("b", 2), ("c", 1)]


def test_top_pages_per_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "0.json", "w") as f:
        for i in range(40):
            f.write(json.dumps({"page": f"p{i % 12:02d}" if i % 3 else "hot", "pos": "1", "vid": 1, "title": "t", "user_id": i % 7}) + "\n")
    stream = spark.readStream.schema("page string, pos string, vid bigint, title string, user_id bigint").json(str(tmp_path / "in"))
    top = counts.batch_top_pages(stream, 3).orderBy(F.desc("pv")).collect()
    assert len(top) == 3 and (top[0]["page"], top[0]["pv"], top[0]["uv"]) == ("hot", 14, 7)


def test_a_repeated_run_adds_nothing(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text("a b")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        lines = text_stream(spark, str(tmp_path / "in"))
        result = counts.run_each_batch(lines, lambda r: word_count(r), out, state)
    assert rows(result.select("word", "n")) == [("a", 1), ("b", 1)]


def test_empty_stream_has_a_schema(spark, tmp_path):
    (tmp_path / "none").mkdir()
    lines = spark.readStream.text(str(tmp_path / "none"))
    got = counts.batch_word_counts(lines, "value", str(tmp_path / "out"))
    assert got.columns == ["word", "n", "batch"] and got.count() == 0


def test_queries_do_not_depend_on_the_sessions_zone(spark, sf):
    from stayline.plans import registry

    registry.load()
    want = sorted(map(tuple, registry.QUERIES["pv_uv"](spark, sf).collect()))
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert sorted(map(tuple, registry.QUERIES["pv_uv"](other, sf).collect())) == want
