"""Queries over episode order statistics and viewing continuity."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.operators import episodes, features
from stayline.plans.oracle_views import with_views
from stayline.plans.registry import query, r6
from stayline.sources import views

_NUMBERS = """nums as (select guid, showname, case when n > 100 then 0 else n end as v from
    (select guid, showname, cast(unnest(regexp_extract_all(title, '[0-9]+')) as double) as n from v1))"""
_GROUPS = """groups as (select guid, showname, list_reverse_sort(list(distinct v)) as v from nums group by guid, showname)"""
_STATS = """stats as (select guid, showname, len(v) as n,
    case when len(v) <= 2 then 0.0::double else v[1] end as max, case when len(v) <= 2 then 0.0::double else v[2] end as max_2,
    case when len(v) <= 2 then 0.0::double else v[len(v)] end as min, case when len(v) <= 2 then 0.0::double else v[len(v) - 1] end as min_2
    from groups)"""
_SCORES = """scores as (select guid, showname, n, case when n - 2 <= 2 or max_2 - min_2 + 1 <= 0 then 0.0
    else (n - 4.0::double) / (max_2 - min_2 + 1) end as continuity from stats)"""
_SHOW = f"with {_NUMBERS}, {_GROUPS}, {_STATS}, {_SCORES} "
GUID_CONTINUITY = f"{_SHOW}, by_guid as (select guid, avg(continuity) as continuity, count(*) as shows from scores group by guid) "


@query("episode_values", with_views("v1", _SHOW + """
    select guid, showname, array_to_string(list_transform(v, lambda x: cast(cast(x as int) as string)), ',') as v from groups"""))
def episode_values(spark, sf_dir):
    rows = episodes.episode_rows(views.view_log(spark, sf_dir), ["guid", "showname"])
    # at most 101 distinct numbers per group
    grouped = rows.groupBy("guid", "showname").agg(F.sort_array(F.collect_set("v"), False).alias("v"))
    return grouped.select("guid", "showname", F.array_join(F.transform("v", lambda x: x.cast("string")), ",").alias("v"))


@query("episode_count", with_views("v1", _SHOW + "select guid, showname, len(v) as n from groups"))
def episode_count(spark, sf_dir):
    keys = ["guid", "showname"]
    bits = episodes.episode_bitmaps(episodes.episode_rows(views.view_log(spark, sf_dir), keys), keys)
    return bits.select(*keys, (F.bit_count("lo") + F.bit_count("hi")).cast("bigint").alias("n"))


@query("episode_order_stats", with_views("v1", _SHOW + "select guid, showname, cast(n as int) as n, max, max_2, min, min_2 from stats"))
def episode_order_stats(spark, sf_dir):
    return episodes.episode_order_stats(views.view_log(spark, sf_dir))


_TITLE = f"""with nums as (select distinct guid, showname, case when n > 100 then 0 else n end as v from
        (select guid, array_to_string(list_transform(list_filter(list_zip(string_split(run, ''), range(1, 100)),
                lambda c: c[1] is not null and list_position(string_split(run, ''), c[1]) = c[2]), lambda c: c[1]), '') as showname,
            cast(unnest(regexp_extract_all(title_han, '[0-9]+')) as double) as n from
            (select guid, title_han, unnest(regexp_extract_all(title_han, '[一-龥]+')) as run from v1))), {_GROUPS}, {_STATS}"""
TITLE_CONTINUITY = f"{_TITLE}, {_SCORES}, by_guid as (select guid, avg(continuity) as continuity, count(*) as shows from scores group by guid) "


@query("episode_order_stats_title", with_views("v1", _TITLE + "select guid, showname, cast(n as int) as n, max, max_2, min, min_2 from stats"))
def episode_order_stats_title(spark, sf_dir):
    return episodes.episode_order_stats_by_name(views.view_log(spark, sf_dir), title="title_han")


_WIDE_STATS = """select showname, n, v[1] as max, coalesce(v[2], v[1]) as max_2, v[n] as min, coalesce(v[n - 1], v[n]) as min_2 from
    (select showname, v, len(v) as n from ({groups}))"""
# v[0] is NULL in DuckDB, so a single value falls back to itself


@query("episode_order_stats_show", with_views("v1", _WIDE_STATS.format(groups="""
    select showname, list_reverse_sort(list(distinct v)) as v from (
        select array_to_string(regexp_extract_all(title_han, '[一-龥]+'), ',') as showname,
            cast(unnest(regexp_extract_all(title_han, '[0-9]+')) as double) as v from v1) group by showname""")))
def episode_order_stats_show(spark, sf_dir):
    return episodes.episode_order_stats_by_show(views.view_log(spark, sf_dir), title="title_han")


@query("episode_order_stats_lastspace", with_views("v1", _WIDE_STATS.format(groups="""
    select showname, list_reverse_sort(list(v)) as v from (
        select regexp_extract(title, '^(.*) ([^ ]*)$', 1) as showname,
            cast(regexp_extract(title, '^(.*) ([^ ]*)$', 2) as double) as v from v1) group by showname""")))
def episode_order_stats_lastspace(spark, sf_dir):
    return episodes.episode_order_stats_last_space(views.view_log(spark, sf_dir))


@query("episode_rows_by_title", with_views("v1", """
    select regexp_extract(title, '^(.*) ([^ ]*)$', 1) as showname, count(*) as n from v1 group by 1"""))
def episode_rows_by_title(spark, sf_dir):
    return episodes.episode_rows_by_title(views.view_log(spark, sf_dir))


@query("episode_count_by_show", with_views("v1", """
    select showname, count(distinct v) as n from (
        select array_to_string(regexp_extract_all(title_han, '[一-龥]+'), ',') as showname,
            cast(unnest(regexp_extract_all(title_han, '[0-9]+')) as double) as v from v1) group by showname"""))
def episode_count_by_show(spark, sf_dir):
    return episodes.episode_count_by_show(views.view_log(spark, sf_dir), title="title_han")


@query("episode_weight_rows", with_views("v1", """
    select distinct guid, array_to_string(list_transform(list_filter(list_zip(string_split(run, ''), range(1, 100)),
            lambda c: c[1] is not null and list_position(string_split(run, ''), c[1]) = c[2]), lambda c: c[1]), '') as showname, weight
    from (select guid, weight, unnest(regexp_extract_all(title_han, '[一-龥]+')) as run from v1
        where regexp_matches(title_han, '[0-9]+'))"""))
def episode_weight_rows(spark, sf_dir):
    return episodes.episode_weight_rows(views.view_log(spark, sf_dir), title="title_han")


@query("continuity_by_show", with_views("v1", _SHOW + "select guid, showname, cast(n as int) as n, round(continuity, 6) as continuity from scores"))
def continuity_by_show(spark, sf_dir):
    return episodes.continuity_by_show(views.view_log(spark, sf_dir)).withColumn("continuity", r6("continuity"))


@query("continuity_by_guid", with_views("v1", GUID_CONTINUITY + "select guid, round(continuity, 6) as continuity, shows from by_guid"))
def continuity_by_guid(spark, sf_dir):
    return episodes.continuity_by_guid(views.view_log(spark, sf_dir)).withColumn("continuity", r6("continuity"))


@query("train_frame", with_views("v1 v3", GUID_CONTINUITY + """
    select c_custkey as guid, cls, round(coalesce(g.continuity, 0.0), 6) as continuity, 11 as n_fields
    from v3 left join by_guid g on g.guid = c_custkey where coalesce(g.continuity, 0.0) <> 0"""))
def train_frame(spark, sf_dir):
    frame = features.train_frame(views.base_feature_lines(spark, sf_dir), episodes.continuity_by_guid(views.view_log(spark, sf_dir)))
    parts = F.split("value", "\t")
    return frame.select(
        F.col("guid").cast("bigint").alias("guid"), F.get(parts, F.lit(1)).alias("cls"), r6("continuity").alias("continuity"),
        F.size(parts).alias("n_fields"),
    )
