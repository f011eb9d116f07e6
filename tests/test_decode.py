"""Decoders, encodings and string helpers on inline rows."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayline.functions import encoding, scalars, strings
from stayline.operators import logs
from stayline.sources import decode, files, views
from stayline.session import scratch_path


def test_split_drops_trailing_empties_only(lines, rows):
    df = lines("a\t\tb\t\t", "\ta").select(F.concat_ws("|", strings.split_fields("value")))
    assert rows(df) == [("a||b",), ("|a",)]


def test_field_past_the_end_is_null(lines):
    assert lines("a\tb").select(strings.field(F.split("value", "\t"), 5)).first()[0] is None


@pytest.mark.parametrize(
    "preset, line, label, features",
    [
        ("churn", "b\ta\tNULL\t3e9\t-3e9\t12", 1.0, [0.0, 0.0, 1e8, -1e8, 12.0]),
        ("churn", "a\tc\tNaN\tInfinity", 0.0, [1.0, 0.0, 0.0]),
        ("churn_b", "b\ta\t3e9", 1.0, [0.0, 3e9]),
        ("keyed_b", "x\tb\ta\t5", 1.0, [0.0, 5.0]),
        ("regression", "x\ty\t1\t2\t3", 3.0, [1.0, 2.0]),
        ("retained", "b\ta\tNULL\tInfinity\t-3e9", 0.0, [1.0, 0.0, 1e8, -1e8]),
        ("bayes", "b\t-4\tNaN\t7", 1.0, [0.0, 0.0, 7.0]),
        ("three_class", "b\tc\ta\t-1\t2", 2.0, [1.0, 0.0, 0.0, 2.0]),
        ("three_class_abc", "c\tb\ta\t2", 3.0, [2.0, 1.0, 2.0]),
        ("svm_binary", "b\tSEQ\t-2\t3", 1.0, [0.0, 0.0, 3.0]),
    ],
)
def test_presets(lines, preset, line, label, features):
    row = encoding.encode_lines(lines(line), preset).first()
    assert (row["label"], row["features"], row["n_bad"]) == (label, features, 0)


def test_unlabelled_preset(lines):
    row = encoding.encode_lines(lines("b\tc\tb\t4"), "unlabelled_c").first()
    assert (row["label"], row["features"]) == (None, [1.0, 0.0, 4.0])


def test_bad_tokens_are_counted(lines):
    row = encoding.encode_lines(lines("a\tinf\tnan\t?\t5"), "churn").first()
    assert row["n_bad"] == 3 and row["features"][-1] == 5.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=30))
def test_clamp_matches_python(spark, xs):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = {r["i"]: r["y"] for r in df.select("i", scalars.clamp("x").alias("y")).collect()}
    assert got == {i: min(max(float(x), -1e8), 1e8) for i, x in enumerate(xs)}


def test_plays_per_guid_keeps_substring_rules(lines, rows):
    df = lines("1\tguid=7&complete=1\tx", "2\txguid=abc&complete=1", "3\tguid=9&complete=0", "4\tguid=7&complete=10")
    assert rows(logs.plays_per_guid(df, "complete=1")) == [("7", 2), ("=abc", 1)]


def test_full_match_is_anchored(lines, rows):
    df = lines("天天 12", "天天 12 a", "x天天12", "天天12").where(strings.matches_all("value", strings.HAN_THEN_NUMBER))
    assert rows(df) == [("天天 12",), ("天天12",)]


def test_distinct_chars_and_pieces(lines):
    row = lines("天天向上").select(strings.distinct_chars("value")).first()
    assert row[0] == "天向上"
    row = lines("a_b_c").select(strings.last_piece("value")).first()
    assert row[0] == "c"


def test_query_strings(lines):
    row = lines("a=1&b=&c=x=y&a=2&d").select(strings.query_pairs("value").alias("p"), strings.query_param("value", "c").alias("c")).first()
    assert [tuple(e) for e in row["p"]] == [("a", "1"), ("b", ""), ("c", "x=y"), ("a", "2"), ("d", "")]
    assert row["c"] == "x=y"
    last = lines("a=1&b=2&a=3&b&ca=9").select(*[strings.last_query_param("value", k) for k in ("a", "b", "c")]).first()
    assert tuple(last) == ("3", "", None)
    assert lines("xguid=3").select(strings.query_param("value", "guid")).first()[0] is None


def test_url_clean(lines, rows):
    assert rows(lines("a%20b", "a%zz").select(strings.url_clean("value"))) == [("",), ("a b",)]


def test_dense_points(lines, rows):
    df = decode.dense_points(lines("-1,1 2", "1,3 x"), recode={-1.0: 0.0})
    assert rows(df) == [(0.0, [1.0, 2.0]), (1.0, [3.0, None])]
    df = decode.dense_points(lines("# note", "7 1 2 1"), "\\s+", "\\s+", comment="#", has_id=True, label="last")
    assert rows(df) == [("7", 1.0, [1.0, 2.0])]


def test_serialized_points(lines):
    df = decode.serialized_points(lines("(1.0,[2.0, 3.0])", "(0.0,(4,[1,3],[5.0,6.0]))", "2.0,7 8", "(1.0,[2,x])", "(1.0,(4,[1],[5.0,6.0]))", "(,[1.0])", "(1.0,[])"))
    got = [(r["label"], r["size"], r["indices"], r["values"], r["corrupt"]) for r in df.collect()]
    assert got[:3] == [(1.0, 2, None, [2.0, 3.0], False), (0.0, 4, [1, 3], [5.0, 6.0], False), (2.0, 2, None, [7.0, 8.0], False)]
    assert [g[4] for g in got[3:]] == [True, True, True, False]


def test_view_log_rules(lines, rows):
    def line(show, channel, title):
        fields = ["f"] * 29
        fields[0], fields[15], fields[19], fields[20] = "g", title, show, channel
        return "\t".join(fields)

    df = lines(line("s", "tv", "天 1"), line("", "tv", "天 2"), line("s", "film", "天 3"), line("s", "tv", "no"), "short\tline tv")
    assert rows(decode.view_log(df, "tv").select("title")) == [("no",), ("天 1",)]
    assert rows(decode.view_log(df, "tv", rule="title").select("title")) == [("天 1",), ("天 2",)]
    assert len(decode.view_log(df).columns) == 29


def test_click_rules(lines, rows):
    def line(code, n=80):
        fields = ["-"] * n
        fields[1], fields[3] = "g1", "o1"
        if n > 75:
            fields[58], fields[73] = "ct%3Dpage%26cn%3Dchan%26title%3Dt1%26title%3Dt2", f"{code},a,b,v3,v4_9"
        return "\t".join(fields)

    df = lines(line("y1.home.channelVideoClick"), line("y2.home_shome.channelVideoClick"), line("y1xhome.channelVideoClick"), line("", 70))
    got = rows(decode.clicks(df, views.CLICK_CODES))
    assert got == [("chan", "9", "v3", "t2", "g1"), ("page", "9", "v4_9", "t2", "o1")]


def test_tuple_sink(spark, rows):
    path = scratch_path(spark, "tuples")
    files.write_tuples(spark.createDataFrame([("a,b", 3), ("c", 1)], "k string, n bigint"), path, "k", "n")
    assert rows(files.read_tuples(spark, path)) == [("a,b", 3), ("c", 1)]


def test_tsv_line_keeps_positions(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    assert df.select(files.tsv_line("a", "b", "c")).first()[0] == "a\tNULL\t3"


def test_guarded_ratio_and_number(spark):
    row = spark.range(1).select(
        scalars.guarded_ratio(F.lit(3.0), F.lit(0.0)).alias("a"), scalars.guarded_ratio(F.lit(3.0), F.lit(-2.0)).alias("b"),
        scalars.number(F.lit("inf")).alias("c"), scalars.number(F.lit("Infinity")).alias("d"), scalars.number(F.lit(" 3 ")).alias("e"),
    ).first()
    assert (row["a"], row["b"], row["c"], row["d"], row["e"]) == (0.0, -1.5, None, math.inf, 3.0)
