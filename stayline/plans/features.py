"""Queries over features, matrices and text tokens."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import functions as F

from stayline.functions.encoding import encode_lines
from stayline.functions.strings import tokens
from stayline.functions.vectors import append_bias
from stayline.operators import features, matrix, tiles
from stayline.plans.oracle_views import hash_number, with_views
from stayline.plans.registry import query, r6
from stayline.sources import views
from stayline.sources.tables import table

_FEATURES = [f"f{i}" for i in range(1, 9)]


def _ratio_rows(spark, sf_dir):
    lines = views.base_feature_lines(spark, sf_dir)
    encoded = encode_lines(lines, "retained", key=True, drop_last=True)
    return features.ratio_features(encoded, ["guid"]).withColumn("guid", F.col("guid").cast("bigint"))


_RETAINED = """base as (select c_custkey as guid, case when cls = 'a' then 1.0::double else 0.0::double end as label, f1,
    case spend_token when '' then least(f2, 1e8) when 'Infinity' then 1e8 else 0.0 end as f2, least(f3, 1e8) as f3, least(f4, 1e8) as f4,
    f5, f6, f7, f8 from v3)"""


@query("ratio_features", with_views("v3", f"""
    with {_RETAINED} select guid, label, f1, f2, f3, f4, f5, f6, f7, f8, round(case when abs(f1) >= 0.001 then f6 / f1 else 0.0 end, 6) as f6_f1,
        round(case when abs(f8) >= 0.001 then f6 / f8 else 0.0 end, 6) as f6_f8,
        round(case when f7 + 1 <> 0 then f6 / (f7 + 1) else 0.0 end, 6) as f6_f7 from base"""))
def ratio_features(spark, sf_dir):
    rows = _ratio_rows(spark, sf_dir)
    return rows.withColumns({c: r6(c) for c in ("f6_f1", "f6_f8", "f6_f7")})


@query("minmax_scale", with_views("v3", f"""
    with {_RETAINED} select guid, label, """ + ", ".join(f"round(({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()), 6) as {c}" for c in _FEATURES) + " from base"))
def minmax_scale(spark, sf_dir):
    rows = features.minmax_scale(_ratio_rows(spark, sf_dir).select("guid", "label", *_FEATURES), _FEATURES)
    return rows.withColumns({c: r6(c) for c in _FEATURES})


@query("append_bias", with_views("v6", """
    select vec_id, len(x) + 1 as n, 1.0::double as first, round(list_sum(x) + 1, 6) as total from v6"""))
def append_bias_rows(spark, sf_dir):
    x = append_bias("x")
    return views.vectors(spark, sf_dir).select(
        "vec_id", F.size(x).cast("bigint").alias("n"), F.get(x, F.lit(0)).alias("first"),
        r6(F.aggregate(x, F.lit(0.0), lambda a, v: a + v)).alias("total"),
    )


@query("tokenize", """
    select doc_id, len(t) as n_tokens, md5(array_to_string(t, '|')) as digest from
        (select doc_id, string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') as t from documents)""")
def tokenize(spark, sf_dir):
    t = tokens("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.md5(F.array_join(t, "|")).alias("digest")
    )


@query("hashing_tf", """
    select doc_id, cast(len(string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s')) as double) as n_terms from documents""")
def hashing_tf(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    words = Tokenizer(inputCol="text", outputCol="words").transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 12).transform(words)
    # which bucket a term falls into is an engine detail; that no term is lost is not
    return counted.select("doc_id", F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, v: a + v).alias("n_terms"))


@query("hashed_terms", f"""
    with t as (select doc_id, unnest(string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s')) as term from documents),
    b as (select doc_id, cast({hash_number('term', 'tf')} % 4096 as int) as bucket, count(*) as n from t group by 1, 2)
    select doc_id, count(*) as buckets, cast(sum(n) as bigint) as terms, cast(sum(n * bucket) as bigint) as weighted, max(n) as most, arg_max(bucket, n * 4096 + bucket) as top from b group by 1""")
def hashed_terms(spark, sf_dir):
    """Every bucket of every document enters: their number, counts, counts by bucket, and the fullest one."""
    words = Tokenizer(inputCol="text", outputCol="words").transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    cells = features.hashed_terms(words, "doc_id", "words", 4096)
    return cells.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("buckets"), F.sum("n").alias("terms"), F.sum(F.col("n") * F.col("bucket")).alias("weighted"), F.max("n").alias("most"),
        F.max_by("bucket", F.col("n") * 4096 + F.col("bucket")).alias("top"),
    )


@query("gram", with_views("v6", """
    select cast(i - 1 as int) as i, cast(j - 1 as int) as j, round(sum(x[i] * x[j]), 6) as v
    from v6, range(1, 65) a(i), range(1, 65) b(j) where i <= j group by 1, 2"""))
def gram(spark, sf_dir):
    return matrix.gram(views.vectors(spark, sf_dir), "x").withColumn("v", r6("v"))


@query("gram_wide", """
    with t as (select o_custkey as r, l_partkey % 4096 as c, sum(l_quantity) as v from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
    g as (select a.c as i, b.c as j, sum(a.v * b.v) as v from t a join t b on a.r = b.r and a.c <= b.c group by 1, 2)
    select i, count(*) as n, sum(v) as total, max(v) as most from g where v <> 0 group by i""")
def gram_wide(spark, sf_dir):
    """How much customers bought of two of 4,096 part groups: the upper triangle, summed up by row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 4096).alias("j"), F.col("l_quantity").alias("v"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.collect_list(F.struct("j", "v")).alias("cells"))
    cells = tiles.untile(tiles.gram_wide(rows, "cells")).where("i <= j")
    return cells.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.max("v").alias("most"))


_WEIGHTS = [[((k * 7 + j * 3) % 11 - 5) / 10 for j in range(64)] for k in range(3)]


@query("linear_score", with_views("v6", """
    select vec_id, """ + ", ".join(f"round(list_inner_product(x, list_transform(range(0, 64), lambda j: (({k} * 7 + j * 3) % 11 - 5) / 10.0::double)), 6) as s{k}" for k in range(3)) + " from v6"))
def linear_score(spark, sf_dir):
    rows = matrix.linear_score(views.vectors(spark, sf_dir), "x", _WEIGHTS, ["vec_id"])
    return rows.withColumns({f"s{k}": r6(f"s{k}") for k in range(3)})


def _supplier_lines(spark, sf_dir, value):
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("i"), F.col("l_linenumber").cast("bigint").alias("j"), value.alias("v"))


_CELLS = "(select l_suppkey as i, cast(l_linenumber as bigint) as j, {} as v from lineitem)"
_BUILT = f"(select i, j, sum(v) as v from {_CELLS} where v <> 0 group by i, j having sum(v) <> 0)"
_QTY, _TAX = "l_quantity - 25", "round(l_tax * 100) - 3"


def _coo_pair(spark, sf_dir):
    a = matrix.coo_build(_supplier_lines(spark, sf_dir, F.col("l_quantity") - 25))
    b = matrix.coo_build(_supplier_lines(spark, sf_dir, F.round(F.col("l_tax") * 100) - 3))
    return a, b


@query("coo_build", f"select i, j, v from {_BUILT.format(_QTY)}")
def coo_build(spark, sf_dir):
    return _coo_pair(spark, sf_dir)[0]


_MATMUL = """
    select a.i, b.j, sum(a.v * b.v) as v from
        (select l_suppkey as i, l_partkey as k, sum(l_quantity) as v from lineitem group by 1, 2) a join
        (select p_partkey as k, cast(substr(p_brand, 7) as bigint) as j, cast(p_size as double) as v from part where p_size <> 0) b on a.k = b.k
    group by a.i, b.j having sum(a.v * b.v) <> 0"""


def _factors(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_quantity").alias("v"))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("i"), F.substring("p_brand", 7, 9).cast("bigint").alias("j"), F.col("p_size").cast("double").alias("v")
    )
    return lines, part


@query("coo_matmul", _MATMUL)
def coo_matmul(spark, sf_dir):
    return matrix.coo_matmul(*_factors(spark, sf_dir))


@query("block_matmul", _MATMUL)
def block_matmul(spark, sf_dir):
    lines, part = _factors(spark, sf_dir)
    return tiles.untile(tiles.multiply(tiles.tile(lines), tiles.tile(part)))


_CONCAT = f"""
    with a as (select * from {_BUILT.format(_QTY)}), b as (select * from {_BUILT.format(_TAX)})
    select 'h' as kind, i, j, v from a union all select 'h', i, j + 8, v from b union all
    select 'v', i, j, v from a union all select 'v', i + 1000000, j, v from b union all select 't', j, i, v from a"""


@query("coo_concat", _CONCAT)
def coo_concat(spark, sf_dir):
    a, b = _coo_pair(spark, sf_dir)
    parts = {"h": matrix.coo_hconcat(a, b, 8), "v": matrix.coo_vconcat(a, b, 1_000_000), "t": matrix.coo_transpose(a)}
    tagged = [m.select(F.lit(k).alias("kind"), "i", "j", "v") for k, m in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("block_concat", _CONCAT)
def block_concat(spark, sf_dir):
    """Offsets that aren't multiples of the tile size: tiles are cut and added at the seams."""
    size = 48
    a, b = (tiles.tile(m, size) for m in _coo_pair(spark, sf_dir))
    parts = {"h": tiles.hconcat(a, b, 8, size), "v": tiles.vconcat(a, b, 1_000_000, size), "t": tiles.transpose(a, size)}
    tagged = [tiles.untile(m, size).select(F.lit(k).alias("kind"), "i", "j", "v") for k, m in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("coo_row_mean", f"""
    with a as (select * from {_BUILT.format(_QTY)}), m as (select i, avg(v) as mean from a group by i)
    select a.i, a.j, round(a.v + m.mean, 6) as v, round(m.mean, 6) as mean from a join m on a.i = m.i""")
def coo_row_mean(spark, sf_dir):
    a, _ = _coo_pair(spark, sf_dir)
    means = matrix.coo_row_mean(a)
    moved = matrix.coo_add_to_columns(a, means.select("i", F.col("mean").alias("x")))
    return moved.join(means, "i").select("i", "j", r6("v").alias("v"), r6("mean").alias("mean"))
