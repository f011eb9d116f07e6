"""Episode order statistics against goldens and a plain-Python model."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stayline.operators import episodes


def model(numbers):
    """n, max, max_2, min, min_2 and continuity of one group."""
    v = sorted({0 if x > 100 else x for x in numbers}, reverse=True)
    n = len(v)
    stats = (0, 0, 0, 0) if n <= 2 else (v[0], v[1], v[-1], v[-2])
    span = stats[1] - stats[3] + 1
    return n, *map(float, stats), 0.0 if n <= 4 or span <= 0 else (n - 4) / span


def frame(spark, groups):
    data = [(str(g), "s", f"x {n}") for g, numbers in enumerate(groups) for n in numbers]
    return spark.createDataFrame(data, "guid string, showname string, title string").repartition(5)


@pytest.mark.parametrize(
    "numbers, expected",
    [
        ([3, 7, 7], (2, 0, 0, 0, 0, 0)),
        ([1, 2, 5], (3, 5, 2, 1, 2, 0)),
        ([1, 2, 3, 4, 5, 6], (6, 6, 5, 1, 2, 0.5)),
        ([1, 2, 3, 4, 500], (5, 4, 3, 0, 1, 1 / 3)),
        ([62, 63, 64, 100, 0], (5, 100, 64, 0, 62, 1 / 3)),
    ],
)
def test_goldens(spark, numbers, expected):
    assert model(numbers) == tuple(map(float, expected))
    df = frame(spark, [numbers])
    r = episodes.episode_order_stats(df).first()
    assert (r["n"], r["max"], r["max_2"], r["min"], r["min_2"]) == tuple(expected[:5])
    assert episodes.continuity_by_show(df).first()["continuity"] == pytest.approx(expected[5])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.integers(0, 130), min_size=1, max_size=40), min_size=1, max_size=20))
def test_matches_model(spark, groups):
    df = frame(spark, groups)
    got = {int(r["guid"]): (r["n"], r["max"], r["max_2"], r["min"], r["min_2"]) for r in episodes.episode_order_stats(df).collect()}
    assert got == {g: model(numbers)[:5] for g, numbers in enumerate(groups)}
    scores = {int(r["guid"]): r["continuity"] for r in episodes.continuity_by_show(df).collect()}
    for g, numbers in enumerate(groups):
        assert scores[g] == pytest.approx(model(numbers)[5])


def test_title_without_number_drops_out(spark):
    df = spark.createDataFrame([("g", "s", "abc"), ("g", "t", "a 1 b 99999999999999999999 2")], "guid string, showname string, title string")
    got = [(r["showname"], r["n"]) for r in episodes.episode_order_stats(df).collect()]
    assert got == [("t", 3)]


def test_by_name_crosses_runs_and_numbers(spark, rows):
    df = spark.createDataFrame([("g", "天天向上 1 大 2"), ("g", "天天向上 3")], "guid string, title string")
    got = rows(episodes.episode_order_stats_by_name(df).select("showname", "n", "max"))
    assert got == [("大", 2, 0.0), ("天向上", 3, 3.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["alpha x", "beta yy", "g"]), st.integers(0, 400)), min_size=1, max_size=60))
def test_last_space_matches_model(spark, pairs):
    titles = [f"{name} {n}" if name != "g" else f"{n}" for name, n in pairs]
    groups = {}
    for t in titles:
        splits = len(t) > 5 and " " in t
        groups.setdefault(t.rsplit(" ", 1)[0] if splits else t, []).append(float(t.rsplit(" ", 1)[1] if splits else t))
    df = spark.createDataFrame([(t,) for t in titles], "title string").repartition(3)
    got = {r["showname"]: (r["n"], r["max"], r["max_2"], r["min"], r["min_2"]) for r in episodes.episode_order_stats_last_space(df).collect()}
    want = {}
    for k, v in groups.items():
        v = sorted(v, reverse=True)
        want[k] = (len(v), v[0], v[1] if len(v) > 1 else v[0], v[-1], v[-2] if len(v) > 1 else v[0])
    assert got == want
    counts = {r["showname"]: r["n"] for r in episodes.episode_rows_by_title(df).collect()}
    assert counts == {k: len(v) for k, v in groups.items()}


def test_by_show_small_groups(spark, rows):
    df = spark.createDataFrame([("天 5",), ("天 5",), ("地 1",), ("地 500",), ("人",)], "title string")
    got = rows(episodes.episode_order_stats_by_show(df))
    assert got == [("人", 0, None, None, None, None), ("地", 2, 500.0, 1.0, 1.0, 500.0), ("天", 1, 5.0, 5.0, 5.0, 5.0)]
    assert rows(episodes.episode_count_by_show(df)) == [("人", 0), ("地", 2), ("天", 1)]


def test_weight_rows(spark, rows):
    df = spark.createDataFrame([("g", 2.0, "天天 1"), ("g", 2.0, "天 7"), ("g", 3.0, "天")], "guid string, weight double, title string")
    assert rows(episodes.episode_weight_rows(df)) == [("g", "天", 2.0)]


def test_one_user_with_a_third_of_all_views(spark):
    df = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 1000 as string)) as guid", "'s' as showname", "concat('e ', cast(id % 90 as string)) as title"
    )
    got = {r["guid"]: r["n"] for r in episodes.episode_order_stats(df).collect()}
    assert got["hot"] == 30
    assert not re.search("collect_", episodes.episode_order_stats(df)._jdf.queryExecution().executedPlan().toString())
