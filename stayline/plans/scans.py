"""Queries over scans, decoders, sinks and token encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions.encoding import encode_lines
from stayline.functions.strings import drop_ends, split_fields
from stayline.operators import logs
from stayline.plans.oracle_views import with_views
from stayline.plans.registry import query, r6
from stayline.session import scratch_path
from stayline.sources import decode, files, views
from stayline.sources.tables import describe_table, table


@query("scan_text", with_views("v2", """
    select count(*) as n_lines, cast(sum(length(line)) as bigint) as n_chars, count(distinct line) as n_distinct from v2"""))
def scan_text(spark, sf_dir):
    path = scratch_path(spark, "play-log")
    views.play_log_lines(spark, sf_dir).write.text(path)
    return decode.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_lines"),
        F.sum(F.length("value") * F.col("n")).alias("n_chars"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


@query("decode_viewlog", with_views("v1", """
    select cast(guid as string) as guid, flag, title, showname, channel as "channelId2",
        cast(l_orderkey as string) as vid, cast(l_linenumber as string) as datecol
    from v1 where l_linenumber <> 7 and channel = 'Brand#3'"""))
def decode_viewlog(spark, sf_dir):
    rows = decode.view_log(views.view_log_lines(spark, sf_dir), channel="Brand#3")
    return rows.select("guid", "flag", "title", "showname", "channelId2", "vid", "datecol")


@query("scan_libsvm", """
    select cast(label as double) as label, count(*) as n_vectors, round(sum(v), 6) as total, sum(case when v <> 0 then 1 else 0 end)::bigint as nnz
    from (select label, vec_id, unnest(cast(embedding as double[])) as v from embeddings) group by label
    """.replace("count(*) as n_vectors", "count(distinct vec_id) as n_vectors"))
def scan_libsvm(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    vectors = views.vectors(spark, sf_dir)
    path = scratch_path(spark, "libsvm")
    vectors.select(files.libsvm_line("label", "x").alias("value")).write.text(path)
    x = vector_to_array("features")
    return (
        files.read_libsvm(spark, path, 64)
        .select("label", F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("s"), F.size(F.filter(x, lambda v: v != 0)).alias("k"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_vectors"), r6(F.sum("s")).alias("total"), F.sum("k").alias("nnz"))
    )


@query("scan_csv", """
    select o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total, min(o_orderkey) as first_key
    from orders group by o_orderpriority""")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.csv(path, header=True)
    orders = files.read_csv(spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string")
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("first_key")
    )


@query("scan_json", """
    select cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n from events group by 1""")
def scan_json(spark, sf_dir):
    path = scratch_path(spark, "props-json")
    table(spark, sf_dir, "events").select(F.col("props").alias("value")).write.text(path)
    return files.read_json(spark, path, "k bigint").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("sql_select", "select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'")
def sql_select(spark, sf_dir):
    return spark.sql(
        "select c_custkey, c_name from {customer} where c_mktsegment = 'BUILDING'",
        customer=table(spark, sf_dir, "customer"),
    )


@query("inline_table", """
    select e.event_type, count(*) as n, round(sum(e.value * coalesce(w.weight, 0.0)), 4) as weighted
    from events e left join (values ('view', 0.1), ('click', 0.25), ('purchase', 1.0), ('signup', 0.5)) w(kind, weight)
        on e.event_type = w.kind group by e.event_type""")
def inline_table(spark, sf_dir):
    weights = spark.createDataFrame(
        [("view", 0.1), ("click", 0.25), ("purchase", 1.0), ("signup", 0.5)], "event_type string, weight double"
    )
    # summed per type first: the join sees one row per type
    per_type = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return per_type.join(weights, "event_type", "left").select(
        "event_type", "n", F.round(F.col("v") * F.coalesce("weight", F.lit(0.0)), 4).alias("weighted")
    )


@query("decode_dense", """
    select p_partkey as id, case when p_partkey % 2 = 0 then 0.0::double else 1.0::double end as label,
        p_retailprice as x1, cast(p_size as double) as x2
    from part where p_partkey % 10 <> 0""")
def decode_dense(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    mark = F.when(F.col("p_partkey") % 10 == 0, "# ").otherwise("")
    y = F.when(F.col("p_partkey") % 2 == 0, "-1").otherwise("1")
    lines = part.select(
        F.concat(mark, F.col("p_partkey").cast("string"), F.lit(" "), y, F.lit("\t"), F.col("p_retailprice").cast("string"),
                 F.lit("  "), F.col("p_size").cast("string")).alias("value")
    )
    points = decode.dense_points(lines, "\\s+", "\\s+", recode={-1.0: 0.0}, comment="#", has_id=True)
    return points.select(
        F.col("id").cast("bigint").alias("id"), "label", F.get("features", F.lit(0)).alias("x1"), F.get("features", F.lit(1)).alias("x2")
    )


@query("scan_ratings", with_views("v5", """
    select cast(user_id as int) as "user", count(*) as n, round(avg(cast(rating as float)), 4) as mean_rating from v5 group by user_id"""))
def scan_ratings(spark, sf_dir):
    path = scratch_path(spark, "ratings")
    views.ratings(spark, sf_dir).write.csv(path)
    return files.read_ratings(spark, path).groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 4).alias("mean_rating")
    )


@query("decode_points", """
    select vec_id, vec_id % 50 = 0 as corrupt,
        case when vec_id % 50 <> 0 then cast(label as double) end as label,
        case when vec_id % 50 <> 0 then cast(len(embedding) as int) end as size,
        case when vec_id % 50 <> 0 then round(list_sum(cast(embedding as double[])), 6) end as total
    from embeddings""")
def decode_points(spark, sf_dir):
    v = views.vectors(spark, sf_dir)
    label = F.col("label").cast("string")
    values = F.array_join(F.transform("x", lambda e: e.cast("string")), ",")
    positions = F.array_join(F.transform("x", lambda e, i: i.cast("string")), ",")
    dense = F.concat(F.lit("("), label, F.lit(",["), values, F.lit("])"))
    sparse = F.concat(F.lit("("), label, F.lit(",("), F.size("x").cast("string"), F.lit(",["), positions, F.lit("],["), values, F.lit("]))"))
    old = F.concat(label, F.lit(","), F.array_join(F.transform("x", lambda e: e.cast("string")), " "))
    line = (
        F.when(F.col("vec_id") % 50 == 0, F.concat(F.lit("("), label, F.lit(",[1.0,x")))
        .when(F.col("vec_id") % 3 == 0, dense).when(F.col("vec_id") % 3 == 1, sparse).otherwise(old)
    )
    points = decode.serialized_points(v.select("vec_id", line.alias("value")), keep=["vec_id"])
    return points.select(
        "vec_id", "corrupt", "label", "size", r6(F.aggregate("values", F.lit(0.0), lambda a, e: a + e)).alias("total")
    )


@query("decode_vec_json", """
    select vec_id, case when vec_id % 2 = 0 then 1 else 0 end as type, cast(len(embedding) as int) as n,
        round(list_sum(cast(embedding as double[])), 6) as total from embeddings""")
def decode_vec_json(spark, sf_dir):
    sparse = F.to_json(F.struct(F.lit(0).alias("type"), F.size("x").alias("size"), F.transform("x", lambda e, i: i).alias("indices"), F.col("x").alias("values")))
    dense = F.to_json(F.struct(F.lit(1).alias("type"), F.col("x").alias("values")))
    lines = views.vectors(spark, sf_dir).select("vec_id", F.when(F.col("vec_id") % 2 == 0, dense).otherwise(sparse).alias("value"))
    v = lines.select("vec_id", decode.vector_json("value").alias("v"))
    return v.select(
        "vec_id", F.col("v.type").alias("type"), F.coalesce("v.size", F.size("v.values")).alias("n"),
        r6(F.aggregate("v.values", F.lit(0.0), lambda a, e: a + e)).alias("total"),
    )


_COUNT = """select guid, count(*) as n from (
    select substr(piece, 6) as guid from (
        select unnest(string_split(field, '&')) as piece from (
            select unnest(string_split(line, chr(9))) as field from v2 where contains(line, '{marker}'))
        where contains(field, '&'))
    where contains(piece, 'guid=')) group by guid"""


@query("count_complete", with_views("v2", _COUNT.format(marker="complete=1")))
def count_complete(spark, sf_dir):
    return logs.plays_per_guid(views.play_log_lines(spark, sf_dir), "complete=1")


@query("count_online", with_views("v2", _COUNT.format(marker="play_types=net")))
def count_online(spark, sf_dir):
    return logs.plays_per_guid(views.play_log_lines(spark, sf_dir), "play_types=net")


@query("sink_roundtrip", with_views("v2", _COUNT.format(marker="complete=1").replace("select guid, count(*)", "select guid as key, count(*)")))
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "complete")
    files.write_tuples(count_complete(spark, sf_dir), path, "guid", "n")
    return files.read_tuples(spark, path)


@query("encode_tsv", """
    select concat_ws(chr(9), cast(o_orderkey as string), cast(o_custkey as string),
        case when o_orderstatus = 'P' then 'NULL' else o_orderstatus end, o_orderpriority) as line from orders""")
def encode_tsv(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(files.tsv_line("o_orderkey", "o_custkey", status, "o_orderpriority").alias("line"))


@query("describe_table", """
    select 'customer' as table_name, d.position, d.column_name, d.column_type, c.n_rows
    from (select count(*) as n_rows from customer) c,
        (values (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'),
            (4, 'c_mktsegment', 'string')) d(position, column_name, column_type)""")
def describe_customer(spark, sf_dir):
    return describe_table(table(spark, sf_dir, "customer"), "customer")


@query("project_cols", "select l_orderkey, l_shipdate::date::string as ship_date from lineitem")
def project_cols(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").cast("string").alias("ship_date"))


_V3_FIELDS = """cast(cast(f1 as bigint) as string), case when spend_token <> '' then spend_token else cast(cast(f2 as bigint) as string) end,
    cast(cast(f3 as bigint) as string), cast(cast(f4 as bigint) as string), cast(cast(f5 as bigint) as string),
    cast(cast(f6 as bigint) as string), cast(cast(f7 as bigint) as string), cast(cast(f8 as bigint) as string)"""


@query("slice_fields", with_views("v3", f"""
    select c_custkey as guid, concat_ws(',', cls, {_V3_FIELDS}) as fields, 9 as n_fields from v3"""))
def slice_fields(spark, sf_dir):
    # two empty fields at the end: dropped by the split, like a JVM split
    lines = views.base_feature_lines(spark, sf_dir).select(split_fields(F.concat("value", F.lit("\t\t"))).alias("p"))
    inner = drop_ends("p", 1, 1)
    return lines.select(
        F.get("p", F.lit(0)).cast("bigint").alias("guid"), F.array_join(inner, ",").alias("fields"), F.size(inner).alias("n_fields")
    )


@query("filter_class", "select o_orderkey, o_custkey from orders where o_orderstatus = 'F'")
def filter_class(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")


@query("filter_range", "select p_partkey, p_size from part where p_size >= 13 and p_size <= 19")
def filter_range(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


@query("filter_title", with_views("v1", """
    select guid, showname, title_han as title from v1
    where channel = 'Brand#3' and regexp_full_match(title_han, '[一-龥]+\\s*[0-9]+')"""))
def filter_title(spark, sf_dir):
    from stayline.functions.strings import HAN_THEN_NUMBER, matches_all

    rows = views.view_log(spark, sf_dir).where((F.col("channel") == "Brand#3") & matches_all("title_han", HAN_THEN_NUMBER))
    return rows.select("guid", "showname", F.col("title_han").alias("title"))


@query("click_decode", """
    select event_id, case when event_id % 4 in (1, 3) then concat('ct-', event_type) else concat('cn-', event_type) end as page,
        regexp_extract(props, '([0-9]+)', 1) as pos,
        case when event_id % 4 in (1, 3) then concat('v', cast(event_id % 50 as string), '_', regexp_extract(props, '([0-9]+)', 1))
            else concat('v', cast(event_id % 50 as string)) end as vid,
        concat('t ', cast(event_id % 50 as string)) as title,
        concat(case when event_id % 4 in (1, 3) then 'o' else 'g' end, cast(user_id as string)) as "user"
    from events where event_id % 10 <> 0 and event_id % 11 <> 0""")
def click_decode(spark, sf_dir):
    return decode.clicks(views.click_log_lines(spark, sf_dir), views.CLICK_CODES, keep=["event_id"])


def _encoded(spark, sf_dir, preset):
    points = encode_lines(views.base_feature_lines(spark, sf_dir), preset, key=True, drop_last=True)
    return points.select(
        F.col("guid").cast("bigint").alias("guid"), "label", *[F.get("features", F.lit(i)).alias(f"x{i + 1}") for i in range(8)], "n_bad"
    )


_REST = "f3 as x3, f4 as x4, f5 as x5, f6 as x6"
_CLAMPED = "least(f2, 1e8) as x2, least(f3, 1e8) as x3, least(f4, 1e8) as x4, f5 as x5, f6 as x6, f7 as x7, f8 as x8, 0 as n_bad"


@query("encode_labels", with_views("v3", f"""
    select c_custkey as guid, case when cls = 'a' then 0.0::double else 1.0::double end as label, f1 as x1,
        {_CLAMPED.replace('least(f2, 1e8)', "case when spend_token <> '' then 0.0 else least(f2, 1e8) end")} from v3"""))
def encode_labels(spark, sf_dir):
    return _encoded(spark, sf_dir, "churn")


@query("encode_labels_inverse", with_views("v3", f"""
    select c_custkey as guid, case when cls = 'a' then 1.0::double else 0.0::double end as label, f1 as x1,
        {_CLAMPED.replace('least(f2, 1e8)', "case spend_token when '' then least(f2, 1e8) when 'Infinity' then 1e8 else 0.0 end")} from v3"""))
def encode_labels_inverse(spark, sf_dir):
    return _encoded(spark, sf_dir, "retained")


@query("encode_labels_multi", with_views("v3", """
    select c_custkey as guid, case cls when 'a' then 0.0::double when 'b' then 2.0 else 1.0 end as label, f1 as x1,
        case spend_token when '' then f2 when 'Infinity' then -1.0 else 0.0 end as x2, f3 as x3, f4 as x4, f5 as x5, f6 as x6,
        greatest(f7, 0.0) as x7, f8 as x8, 0 as n_bad from v3"""))
def encode_labels_multi(spark, sf_dir):
    rows = _encoded(spark, sf_dir, "three_class")
    # infinity is kept by this layout; shown as -1 so that results stay comparable
    return rows.withColumn("x2", F.when(F.col("x2") == float("inf"), F.lit(-1.0)).otherwise(F.col("x2")))


def _preset_sql(preset: str, label: str, special: str, numbers: str, bad: str) -> str:
    """``special`` is what f2 becomes when it is no number; ``numbers`` are the columns of the features."""
    first = f"case spend_token when '' then f2 {special} end"
    names = numbers.split()
    cells = [first if c == "f2" else "greatest(f7, 0.0)" if c == "f7+" else c for c in names]
    columns = ", ".join(f"cast({cells[i] if i < len(cells) else 'null'} as double) as x{i + 1}" for i in range(8))
    return f"select '{preset}' as preset, c_custkey as guid, cast({label} as double) as label, {columns}, cast({bad} as int) as n_bad from v3"


_C_BAD, _NULL_BAD = "case when cls = 'c' then 1 else 0 end", "case when spend_token = 'NULL' then 1 else 0 end"
_B_ONLY = "case cls when 'b' then 1 when 'a' then 0 end"
_RAW = "when 'NaN' then -2 when 'Infinity' then -1"  # shown so that results stay comparable
_ALL = "f1 f2 f3 f4 f5 f6 f7 f8"


@query("encode_labels_presets", with_views("v3", " union all ".join([
    _preset_sql("churn_b", _B_ONLY, "else 0", _ALL, _C_BAD),
    _preset_sql("unlabelled_c", "null", "when 'NaN' then 0 when 'Infinity' then 0", _ALL, _NULL_BAD),
    _preset_sql("keyed_b", "f1", _RAW, "f2 f3 f4 f5 f6 f7 f8", _NULL_BAD),
    _preset_sql("regression", "f8", _RAW, "f2 f3 f4 f5 f6 f7", _NULL_BAD),
    _preset_sql("bayes", _B_ONLY, "when 'Infinity' then -1 else 0", _ALL.replace("f7", "f7+"), _C_BAD),
    _preset_sql("three_class_abc", "case cls when 'a' then 1 when 'b' then 2 else 3 end", "when 'Infinity' then -1 else 0", _ALL, "0"),
    _preset_sql("svm_binary", _B_ONLY, "when 'Infinity' then -1 else 0", _ALL.replace("f7", "f7+"), _C_BAD),
])))
def encode_labels_presets(spark, sf_dir):
    """The other layouts, each with its name."""
    lines, rows = views.base_feature_lines(spark, sf_dir), None
    shown = lambda x: F.when(F.isnan(x), -2.0).when(x == float("inf"), -1.0).otherwise(x)
    for preset in ("churn_b", "unlabelled_c", "keyed_b", "regression", "bayes", "three_class_abc", "svm_binary"):
        points = encode_lines(lines, preset, key=True, drop_last=True)
        part = points.select(
            F.lit(preset).alias("preset"), F.col("guid").cast("bigint").alias("guid"), "label",
            *[shown(F.get("features", F.lit(i))).alias(f"x{i + 1}") for i in range(8)], "n_bad",
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows
