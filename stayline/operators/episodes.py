"""Episode order statistics and viewing continuity.

Episode numbers above 100 count as 0, so the distinct numbers of a (user, show) group are a subset of
0…100. The group is therefore aggregated into two bitmaps (0…62 and 63…100) with ``bit_or``: a fixed
16-byte buffer that combines map-side inside generated code, whatever the size of the group. All order
statistics are then arithmetic on the bitmaps. Variants without that bound keep only the two largest and
two smallest rows per group and partition before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.strings import HAN_RUNS, NUMBERS, after_last_space, before_last_space, distinct_chars, find_all, strip

TOP = 100  # fixed value: larger episode numbers count as 0
SPLIT = 63  # bits in the low bitmap
STATS = ("max", "max_2", "min", "min_2")


def episode_number(run: Column | str) -> Column:
    """Digit run → whole number 0…100."""
    value = (F.col(run) if isinstance(run, str) else run).try_cast("double")
    return F.when(value > TOP, F.lit(0)).otherwise(value).cast("int")


def episode_rows(views: DataFrame, keys: list[str], title: str = "title", pattern: str = NUMBERS) -> DataFrame:
    """One row per number in a title: keys and v. Titles without a number drop out."""
    return views.select(*keys, F.explode(find_all(title, pattern)).alias("_run")).select(
        *keys, episode_number("_run").alias("v")
    )


def name_episode_rows(
    views: DataFrame, keys: list[str], title: str = "title", names: str = HAN_RUNS, pattern: str = NUMBERS
) -> DataFrame:
    """Keys, name and v for every name run × number of a title.

    The patterns stand inside ``explode``: over a column, Spark would infer a size filter and push it down,
    which runs the pattern a second time.
    """
    return (
        views.select(*keys, title, F.explode(find_all(title, names)).alias("name"))
        .select(*keys, "name", F.explode(find_all(title, pattern)).alias("_run"))
        .select(*keys, "name", episode_number("_run").alias("v"))
    )


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _highest(bits: Column) -> Column:
    return F.length(F.bin(bits)) - 1


def _lowest(bits: Column) -> Column:
    return F.length(F.bin(bits.bitwiseAND(-bits))) - 1


def _top(lo: Column, hi: Column) -> Column:
    return F.when(hi != 0, _highest(hi) + SPLIT).when(lo != 0, _highest(lo))


def _bottom(lo: Column, hi: Column) -> Column:
    return F.when(lo != 0, _lowest(lo)).when(hi != 0, _lowest(hi) + SPLIT)


def _without(lo: Column, hi: Column, v: Column) -> tuple[Column, Column]:
    """Both bitmaps with the bit of v cleared."""
    in_hi = v >= SPLIT
    return (
        F.when(in_hi, lo).otherwise(lo.bitwiseXOR(_bit(F.when(in_hi, 0).otherwise(v)))),
        F.when(in_hi, hi.bitwiseXOR(_bit(F.when(in_hi, v - SPLIT).otherwise(0)))).otherwise(hi),
    )


def episode_bitmaps(rows: DataFrame, keys: list[str], v: str = "v") -> DataFrame:
    """keys, lo, hi: which numbers 0…62 and 63…100 occur."""
    low, zero = F.col(v) < SPLIT, F.lit(0).cast("bigint")
    return rows.groupBy(*keys).agg(
        F.bit_or(F.when(low, _bit(F.col(v))).otherwise(zero)).alias("lo"),
        F.bit_or(F.when(low, zero).otherwise(_bit(F.col(v) - SPLIT))).alias("hi"),
    )


def order_stats(bitmaps: DataFrame, keys: list[str], small: str = "zero") -> DataFrame:
    """keys, n and the four order statistics as doubles.

    ``small='zero'``: groups of one or two numbers give 0 for all four. With three numbers max_2 and
    min_2 are both the middle one, which the positions give by themselves.
    """
    df = bitmaps.select(*keys, (F.bit_count("lo") + F.bit_count("hi")).alias("n"), "lo", "hi")
    lo, hi = F.col("lo"), F.col("hi")
    df = df.withColumns({"_max": _top(lo, hi), "_min": _bottom(lo, hi)})
    top2 = _top(*_without(lo, hi, F.col("_max")))
    bottom2 = _bottom(*_without(lo, hi, F.col("_min")))
    raw = {"max": F.col("_max"), "max_2": top2, "min": F.col("_min"), "min_2": bottom2}
    if small == "zero":
        raw = {k: F.when(F.col("n") <= 2, F.lit(0)).otherwise(c) for k, c in raw.items()}
    return df.select(*keys, "n", *[c.cast("double").alias(k) for k, c in raw.items()])


def episode_order_stats(views: DataFrame, keys: list[str] = ["guid", "showname"], title: str = "title") -> DataFrame:
    return order_stats(episode_bitmaps(episode_rows(views, keys, title), keys), keys)


def episode_order_stats_by_name(views: DataFrame, key: str = "guid", title: str = "title", names: str = HAN_RUNS) -> DataFrame:
    """Order statistics per (key, show); a show is a name run of the title without repeated characters.

    Bitmaps are built per raw run first, so characters are compared once per group instead of once per view.
    """
    by_run = episode_bitmaps(name_episode_rows(views, [key], title, names), [key, "name"])
    keys = [key, "showname"]
    by_show = (
        by_run.select(key, distinct_chars("name").alias("showname"), "lo", "hi")
        .groupBy(*keys)
        .agg(F.bit_or("lo").alias("lo"), F.bit_or("hi").alias("hi"))
    )
    return order_stats(by_show, keys)


def continuity_score(n: Column | str, max_2: Column | str, min_2: Column | str) -> Column:
    """(n - 4) / span with span = max_2 - min_2 + 1; 0 for n ≤ 4 or an empty span."""
    n, max_2, min_2 = (F.col(c) if isinstance(c, str) else c for c in (n, max_2, min_2))
    span = max_2 - min_2 + 1
    return F.when((n <= 4) | (span <= 0), F.lit(0.0)).otherwise(F.try_divide((n - 4).cast("double"), span))


def continuity_by_show(views: DataFrame, guid: str = "guid", show: str = "showname", title: str = "title") -> DataFrame:
    stats = episode_order_stats(views, [guid, show], title)
    return stats.select(guid, show, "n", continuity_score("n", "max_2", "min_2").alias("continuity"))


def continuity_by_guid(views: DataFrame, guid: str = "guid", show: str = "showname", title: str = "title") -> DataFrame:
    """Plain mean of the show scores, and the number of shows."""
    return _mean_score(continuity_by_show(views, guid, show, title), guid)


def continuity_by_title(views: DataFrame, guid: str = "guid", title: str = "title", names: str = HAN_RUNS) -> DataFrame:
    """The same with shows read from the titles' name runs."""
    stats = episode_order_stats_by_name(views, guid, title, names)
    return _mean_score(stats.select(guid, continuity_score("n", "max_2", "min_2").alias("continuity")), guid)


def _mean_score(scores: DataFrame, guid: str) -> DataFrame:
    return scores.groupBy(guid).agg(F.avg("continuity").alias("continuity"), F.count(F.lit(1)).alias("shows"))


def _counted_titles(titles: DataFrame, title: str) -> DataFrame:
    """Distinct titles and how often each occurs (``title``, ``times``).

    Popular titles repeat, so the pattern work below runs once per title instead of once per view.
    """
    return titles.groupBy(F.col(title).alias("title")).agg(F.count(F.lit(1)).alias("times"))


def edge_stats(rows: DataFrame, keys: list[str], v: str = "v", repeats: bool = False, times: str | None = None) -> DataFrame:
    """n and the four order statistics over unbounded values; a single value fills all four.

    With ``repeats`` equal values count as often as they occur (``times`` names a column of row counts), else
    once. Values are counted per
    (keys, value) first. Of those cells the two largest and two smallest per group are found by
    ``row_number() <= 2``, which Spark applies per partition before the shuffle, so a group that holds most
    of the rows still sends two cells per partition. A group without any value keeps NULLs.
    """
    cells = rows.groupBy(*keys, v).agg((F.sum(times) if times else F.count(F.lit(1))).alias("_n"))
    number = F.sum(F.when(F.col(v).isNotNull(), F.col("_n"))) if repeats else F.count(v)
    counts = cells.groupBy(*keys).agg(F.coalesce(number, F.lit(0)).cast("bigint").alias("n"))

    def edge(order: Column, first: str, second: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order)
        top = cells.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
        one, two = (F.max(F.when(F.col("_rn") == i, F.col(v))) for i in (1, 2))
        again = F.max(F.when((F.col("_rn") == 1) & (F.col("_n") > 1), F.col(v))) if repeats else F.lit(None)
        return top.groupBy(*keys).agg(one.alias(first), F.coalesce(again, two, one).alias(second))

    high = edge(F.desc_nulls_last(v), "max", "max_2")
    low = edge(F.asc_nulls_last(v), "min", "min_2")
    return counts.join(high, keys).join(low, keys).select(*keys, "n", "max", "max_2", "min", "min_2")


def _show_rows(titles: DataFrame, title: str, names: str) -> DataFrame:
    """showname (list of name runs) and v per number; a title without a number gives one NULL."""
    rows = _counted_titles(titles, title).select(
        F.array_join(find_all("title", names), ",").alias("showname"),
        F.explode_outer(find_all("title", NUMBERS)).alias("_run"),
    )
    return rows.select("showname", F.col("_run").try_cast("double").alias("v"))


def episode_order_stats_by_show(titles: DataFrame, title: str = "title", names: str = HAN_RUNS) -> DataFrame:
    """Per list of name runs: order statistics of the distinct unclamped numbers; NULL where there are none."""
    return edge_stats(_show_rows(titles, title, names), ["showname"])


def split_last_space(title: Column | str) -> tuple[Column, Column]:
    """(name, number text): titles longer than five characters with a space split at the last one."""
    t = F.col(title) if isinstance(title, str) else title
    splits = (F.length(t) > 5) & t.contains(" ")
    return (
        F.when(splits, strip(before_last_space(t))).otherwise(t),
        F.when(splits, strip(after_last_space(t))).otherwise(t),
    )


def episode_order_stats_last_space(titles: DataFrame, title: str = "title") -> DataFrame:
    """Per name before the last space: order statistics of the numbers after it, repeats included."""
    name, text = split_last_space("title")
    rows = _counted_titles(titles, title).select(name.alias("showname"), text.try_cast("double").alias("v"), "times")
    return edge_stats(rows, ["showname"], repeats=True, times="times")


def episode_rows_by_title(titles: DataFrame, title: str = "title") -> DataFrame:
    """Rows per name before the last space, repeats included."""
    rows = _counted_titles(titles, title).select(split_last_space("title")[0].alias("showname"), "times")
    return rows.groupBy("showname").agg(F.sum("times").alias("n"))


def episode_count_by_show(titles: DataFrame, title: str = "title", names: str = HAN_RUNS) -> DataFrame:
    """Distinct numbers per list of name runs; 0 where no title has a number."""
    cells = _show_rows(titles, title, names).distinct()
    return cells.groupBy("showname").agg(F.count("v").alias("n"))


def episode_weight_rows(views: DataFrame, key: str = "guid", weight: str = "weight", title: str = "title", names: str = HAN_RUNS) -> DataFrame:
    """Distinct (key, show, weight) of titles that have a number."""
    with_number = views.where(F.col(title).rlike(NUMBERS))
    return with_number.select(
        key, F.explode(find_all(title, names)).alias("_name"), weight
    ).select(key, distinct_chars("_name").alias("showname"), weight).distinct()
