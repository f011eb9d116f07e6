"""Queries over string, math and vector column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions import scalars, strings, vectors
from stayline.operators import logs
from stayline.plans.oracle_views import with_views
from stayline.plans.registry import query, r6
from stayline.sources import views
from stayline.sources.tables import table


@query("str_split", """
    select doc_id, len(string_split(text, ' ')) as by_space, len(string_split(text, ',')) as by_comma,
        len(string_split_regex(text, '\\s+')) as by_white, string_split(text, ' ')[1] as first_word, string_split(text, ' ')[2] as second_word
    from documents""")
def str_split(spark, sf_dir):
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("by_space"), F.size(F.split("text", ",")).cast("bigint").alias("by_comma"),
        F.size(F.split("text", "\\s+")).cast("bigint").alias("by_white"),
        F.get(words, F.lit(0)).alias("first_word"), F.get(words, F.lit(1)).alias("second_word"),
    )


@query("word_count", """
    select word, count(*) as n from (select unnest(string_split(text, ' ')) as word from documents) group by word""")
def word_count(spark, sf_dir):
    return logs.word_count(table(spark, sf_dir, "documents"), "text")


@query("str_basic", """
    select doc_id, length(regexp_replace(text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) as n_stripped,
        contains(text, 'the') as has_the, starts_with(text, 'T') as starts_t from documents""")
def str_basic(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(strings.strip("text")).cast("bigint").alias("n_stripped"),
        F.contains("text", F.lit("the")).alias("has_the"), F.startswith("text", F.lit("T")).alias("starts_t"),
    )


@query("param_guid", "select event_id, cast(user_id as string) as guid, cast(null as string) as absent from events")
def param_guid(spark, sf_dir):
    lines = views.play_log_lines(spark, sf_dir).select(F.split("value", "\t").alias("p"))
    query_text = F.get("p", F.lit(1))
    return lines.select(
        F.get("p", F.lit(0)).cast("bigint").alias("event_id"), strings.query_param(query_text, "guid").alias("guid"),
        strings.query_param(query_text, "uid").alias("absent"),
    )


@query("param_map", """
    select page_id, string_split(pair, '=')[1] as key, case when contains(pair, '=') then regexp_replace(pair, '^[^=]*=', '') else '' end as value
    from (select page_id, unnest(string_split(concat(regexp_extract(url, '[?]([^#]*)', 1), '&empty=&bare&sum=a=b'), '&')) as pair from pages)
    where pair <> ''""")
def param_map(spark, sf_dir):
    text = F.concat(F.regexp_extract("url", "[?]([^#]*)", 1), F.lit("&empty=&bare&sum=a=b"))
    return table(spark, sf_dir, "pages").select("page_id", F.inline(strings.query_pairs(text)))


@query("url_clean", "select page_id, case when page_id % 7 = 0 then '' else url end as url from pages")
def url_clean(spark, sf_dir):
    encoded = F.concat(F.url_encode("url"), F.when(F.col("page_id") % 7 == 0, "%zz").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", strings.url_clean(encoded).alias("url"))


@query("extract_numbers", """
    select page_id, array_to_string(regexp_extract_all(html, '[0-9]+'), ',') as numbers, len(regexp_extract_all(html, '[0-9]+')) as n from pages""")
def extract_numbers(spark, sf_dir):
    found = strings.find_all("html", strings.NUMBERS)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(found, ",").alias("numbers"), F.size(found).cast("bigint").alias("n")
    )


@query("extract_cjk", with_views("v1", """
    select title_han, array_to_string(regexp_extract_all(title_han, '[一-龥]+'), ',') as runs, count(*) as n from v1 group by title_han"""))
def extract_cjk(spark, sf_dir):
    titles = views.view_log(spark, sf_dir).groupBy("title_han").agg(F.count(F.lit(1)).alias("n"))
    return titles.select("title_han", F.array_join(strings.find_all("title_han", strings.HAN_RUNS), ",").alias("runs"), "n")


@query("distinct_chars", """
    select p_partkey, array_to_string(list_transform(list_filter(list_zip(string_split(p_name, ''), range(1, 100)),
        lambda c: c[1] is not null and list_position(string_split(p_name, ''), c[1]) = c[2]), lambda c: c[1]), '') as chars from part""")
def distinct_chars(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", strings.distinct_chars("p_name").alias("chars"))


@query("clamp", """
    select o_orderkey, least(greatest((o_totalprice - 200000) * 1000, -1e8), 1e8) as x,
        case when o_custkey > 100 then 0 else o_custkey end as v from orders""")
def clamp(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.clamp((F.col("o_totalprice") - 200000) * 1000).alias("x"),
        F.when(F.col("o_custkey") > 100, 0).otherwise(F.col("o_custkey")).alias("v"),
    )


@query("math_fns", """
    select event_id, round(pow(value, 1.5), 6) as p, round(sqrt(value), 6) as s, round(exp(-value / 100), 6) as e, round(ln(value + 1), 6) as l,
        round(ln(1 + value), 6) as l1, round(tanh(value / 100), 6) as t, round(1 / (1 + exp(-(value - 50) / 10)), 6) as g,
        round(1.7159 * tanh(value / 50 * 2 / 3), 6) as h, cast(floor(value) as bigint) as f, cast(ceil(value) as bigint) as c
    from events""")
def math_fns(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", r6(F.pow(v, F.lit(1.5))).alias("p"), r6(F.sqrt(v)).alias("s"), r6(F.exp(-v / 100)).alias("e"),
        r6(F.log(v + 1)).alias("l"), r6(F.log1p(v)).alias("l1"), r6(F.tanh(v / 100)).alias("t"),
        r6(scalars.sigmoid((v - 50) / 10)).alias("g"), r6(scalars.scaled_tanh(v / 50)).alias("h"),
        F.floor(v).cast("bigint").alias("f"), F.ceil(v).cast("bigint").alias("c"),
    )


def _vectors(spark, sf_dir):
    return views.vectors(spark, sf_dir).select("vec_id", "x", F.reverse("x").alias("y"))


@query("vec_dot", with_views("v6", "select vec_id, round(list_inner_product(x, list_reverse(x)), 6) as dot from v6"))
def vec_dot(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", r6(vectors.dot("x", "y")).alias("dot"))


@query("vec_axpy", with_views("v6", """
    select vec_id, cast(i - 1 as int) as position, round(2.5 * x[i] + y[i], 6) as axpy, round(3.0 * x[i], 6) as scaled,
        round(x[i] + y[i], 6) as added, round(x[i] - y[i], 6) as less, round(x[i] * y[i], 6) as times,
        case when y[i] = 0 then 0.0 else round(x[i] / y[i], 4) end as over
    from (select vec_id, x, list_reverse(x) as y from v6), range(1, 65) t(i)"""))
def vec_axpy(spark, sf_dir):
    out = F.arrays_zip(
        vectors.axpy(2.5, "x", "y").alias("axpy"), vectors.scale(3.0, "x").alias("scaled"), vectors.combine("x", "y", "add").alias("added"),
        vectors.combine("x", "y", "sub").alias("less"), vectors.combine("x", "y", "mul").alias("times"), vectors.combine("x", "y", "div").alias("over"),
    )
    rows = _vectors(spark, sf_dir).select("vec_id", F.posexplode(out).alias("position", "e"))
    return rows.select(
        "vec_id", "position", *[r6(f"e.{c}").alias(c) for c in ("axpy", "scaled", "added", "less", "times")], F.round("e.over", 4).alias("over")
    )


@query("vec_norm", with_views("v6", """
    select vec_id, round(list_sum(list_transform(x, lambda v: abs(v))), 6) as l1, round(sqrt(list_inner_product(x, x)), 6) as l2,
        round(list_max(list_transform(x, lambda v: abs(v))), 6) as linf,
        round(pow(list_sum(list_transform(x, lambda v: pow(abs(v), 3))), 1.0 / 3), 6) as l3 from v6"""))
def vec_norm(spark, sf_dir):
    return _vectors(spark, sf_dir).select(
        "vec_id", *[r6(vectors.norm("x", p)).alias(n) for p, n in ((1, "l1"), (2, "l2"), (float("inf"), "linf"), (3, "l3"))]
    )


@query("vec_sqdist", with_views("v6", """
    select vec_id, round(pow(list_distance(x, list_reverse(x)), 2), 6) as d from v6"""))
def vec_sqdist(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", r6(vectors.sqdist("x", "y")).alias("d"))


@query("vec_argmax", with_views("v6", """
    select vec_id, cast(list_position(x, list_max(x)) - 1 as int) as argmax, cast(len(list_filter(x, lambda v: abs(v) >= 0.05)) as int) as nonzero
    from v6"""))
def vec_argmax(spark, sf_dir):
    thin = F.transform("x", lambda v: F.when(F.abs(v) >= 0.05, v).otherwise(0.0))
    return _vectors(spark, sf_dir).select("vec_id", vectors.argmax("x").alias("argmax"), vectors.count_nonzero(thin).alias("nonzero"))


@query("vec_compress", with_views("v6", """
    select vec_id, 64 as size, len(kept) as nnz, 1.5 * (len(kept) + 1) < 64 as sparse_is_smaller,
        array_to_string(list_transform(kept, lambda i: cast(i - 1 as string)), ',') as indices,
        coalesce(round(list_sum(list_transform(kept, lambda i: x[i])), 6), 0.0) as total
    from (select vec_id, x, list_filter(range(1, 65), lambda i: abs(x[i]) >= 0.15) as kept from v6)"""))
def vec_compress(spark, sf_dir):
    thin = F.transform("x", lambda v: F.when(F.abs(v) >= 0.15, v).otherwise(0.0))
    rows = _vectors(spark, sf_dir).select("vec_id", thin.alias("x")).select("vec_id", "x", vectors.to_sparse("x").alias("s"))
    back = vectors.to_dense("s")
    return rows.select(
        "vec_id", F.col("s.size").alias("size"), F.size("s.indices").cast("bigint").alias("nnz"), vectors.is_smaller_sparse("x").alias("sparse_is_smaller"),
        F.array_join(F.transform("s.indices", lambda i: i.cast("string")), ",").alias("indices"),
        r6(F.aggregate(back, F.lit(0.0), lambda a, v: a + v)).alias("total"),
    )


@query("vec_from_pairs", """
    with pairs as (
        select user_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k, value from events
        union all select user_id, 100 + event_id % 3, value from events where event_id % 1000 = 0
    )
    select user_id, string_agg(cast(k as string), ',' order by k) filter (where k < 100) as indices,
        round(sum(v) filter (where k < 100), 6) as total, cast(sum(n - 1) as bigint) as duplicates,
        cast(sum(case when k < 100 then 0 else 1 end) as bigint) as out_of_range
    from (select user_id, k, count(*) as n, max(value) as v from pairs group by 1, 2)
    group by user_id""")
def vec_from_pairs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    pairs = events.select("user_id", F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("index"), "value")
    # some pairs beyond the end of the vector, to be counted
    beyond = events.where("event_id % 1000 = 0").select("user_id", (100 + F.col("event_id") % 3).cast("int"), "value")
    built = vectors.from_pairs(pairs.union(beyond), "user_id", 100)
    return built.select(
        "user_id", F.array_join(F.transform("vector.indices", lambda i: i.cast("string")), ",").alias("indices"),
        r6(F.aggregate("vector.values", F.lit(0.0), lambda a, v: a + v)).alias("total"), "duplicates",
        F.col("out_of_range").cast("bigint").alias("out_of_range"),
    )
