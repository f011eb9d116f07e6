"""Queries over joins, aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.operators import graph, matrix, metrics, relational
from stayline.plans.oracle_views import with_views
from stayline.plans.registry import query, r6
from stayline.sources import views
from stayline.sources.tables import table


@query("join_inner_multi", """
    select a.l_suppkey, a.l_partkey, a.quantity, b.orders from
        (select l_suppkey, l_partkey, sum(l_quantity) as quantity from lineitem group by 1, 2) a
        join (select l_suppkey, l_partkey, count(distinct l_orderkey) as orders from lineitem group by 1, 2) b
        on a.l_suppkey = b.l_suppkey and a.l_partkey = b.l_partkey""")
def join_inner_multi(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey")
    quantity = pairs.agg(F.sum("l_quantity").alias("quantity"))
    return quantity.join(pairs.agg(F.countDistinct("l_orderkey").alias("orders")), ["l_suppkey", "l_partkey"])


@query("join_inner", "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey")
def join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(customers, "c_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query("join_left_fill", """
    select c_custkey, coalesce(t.urgent, 0.0) as urgent from customer left join
        (select o_custkey, cast(count(*) as double) as urgent from orders where o_orderpriority = '1-URGENT' group by o_custkey) t
        on c_custkey = o_custkey""")
def join_left_fill(spark, sf_dir):
    urgent = (
        table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("urgent"))
    )
    return relational.left_join_fill(table(spark, sf_dir, "customer").select("c_custkey"), urgent, ["c_custkey"], {"urgent": 0.0})


@query("join_full", """
    select coalesce(a.k, b.k) as k, a.n_events, b.n_orders from
        (select user_id as k, count(*) as n_events from events group by 1) a
        full join (select o_custkey as k, count(*) as n_orders from orders group by 1) b on a.k = b.k""")
def join_full(spark, sf_dir):
    acts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    bought = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    return relational.full_join(acts, bought, ["k"])


@query("join_cogroup", """
    select user_id as key, 'left' as side, event_type as value, count(*) as n from events group by 1, 3
    union all select o_custkey, 'right', o_orderpriority, count(*) from orders group by 1, 3""")
def join_cogroup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "user_id")
    return relational.cogroup_values(table(spark, sf_dir, "events"), orders, "user_id", "event_type", "o_orderpriority")


@query("join_cross", "select c_custkey, r_name from customer, region")
def join_cross(spark, sf_dir):
    return relational.cartesian(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "region").select("r_name"))


@query("key_by", "select user_id % 10 as key, event_id, user_id from events")
def key_by(spark, sf_dir):
    keyed = relational.key_by(table(spark, sf_dir, "events").select("event_id", "user_id"), F.col("user_id") % 10)
    return keyed.select("key", "event_id", "user_id")


@query("sql_join_agg", """
    select o_orderpriority as priority, sum(l_quantity) as units, round(sum(l_extendedprice), 2) as revenue
    from orders join lineitem on o_orderkey = l_orderkey group by o_orderpriority""")
def sql_join_agg(spark, sf_dir):
    return spark.sql(
        """
        with per_order as (
            select l_orderkey as o_orderkey, sum(l_quantity) as units, sum(l_extendedprice) as revenue from {lines} group by all
        )
        select o_orderpriority as priority, sum(units) as units, round(sum(revenue), 2) as revenue
        from {orders} join per_order using (o_orderkey) group by all
        """,
        orders=table(spark, sf_dir, "orders"),
        lines=table(spark, sf_dir, "lineitem"),
    )


@query("join_actual_pred", with_views("v5", """
    select count(*) as n, round(avg((p.pred - a.rating) * (p.pred - a.rating)), 6) as mse from v5 a join
        (select user_id, item, round(avg(rating) over (partition by user_id), 6) as pred from v5) p
        on a.user_id = p.user_id and a.item = p.item"""))
def join_actual_pred(spark, sf_dir):
    actual = views.ratings(spark, sf_dir)
    means = actual.groupBy("user_id").agg(r6(F.avg("rating")).alias("pred"))
    predicted = actual.select("user_id", "item").join(means, "user_id")
    return metrics.mse(actual.join(predicted, ["user_id", "item"]), "rating", "pred").select("n", r6("mse").alias("mse"))


@query("avg_by_date", """
    select cast(cast(o_orderdate as date) as string) as day, round(avg(o_totalprice), 6) as mean_price, round(avg(o_custkey), 6) as mean_key
    from orders group by 1""")
def avg_by_date(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").cast("string").alias("day")
    return table(spark, sf_dir, "orders").groupBy(day).agg(
        r6(F.avg("o_totalprice")).alias("mean_price"), r6(F.avg("o_custkey")).alias("mean_key")
    )


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates()


_STATS = " union all ".join(
    f"select '{c}' as column_name, round(avg({c}), 6) as mean, round(var_samp({c}), 4) as variance, "
    f"count(case when {c} <> 0 then 1 end) as nonzero, max({c}) as max, min({c}) as min from lineitem"
    for c in ("l_quantity", "l_discount", "l_tax")
)


@query("col_stats", _STATS)
def col_stats(spark, sf_dir):
    stats = matrix.column_stats(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return stats.select("column_name", r6("mean").alias("mean"), F.round("variance", 4).alias("variance"), "nonzero", "max", "min")


@query("tree_sum", with_views("v6", """
    select cast(i - 1 as int) as position, round(sum(x[i]), 6) as total, count(*) as n
    from v6, range(1, 65) t(i) group by i"""))
def tree_sum(spark, sf_dir):
    return matrix.vector_sum(views.vectors(spark, sf_dir), "x").select("position", r6("total").alias("total"), "n")


@query("sort_label", with_views("v8", "select id, label from v8 order by label, id"))
def sort_label(spark, sf_dir):
    return views.scored_events(spark, sf_dir).select("id", "label").orderBy("label", "id")


@query("head_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def head_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


_CLASS = "select o_orderkey, o_orderstatus from orders where o_orderstatus = '{}'"


@query("union_all", " union all ".join(_CLASS.format(c) for c in "FPOP"))
def union_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    a, b, c = (orders.where(F.col("o_orderstatus") == s) for s in "FOP")
    return relational.bag_union(a, c, b, c)


_ROUNDS = 5


def _pagerank_sql() -> str:
    steps = [
        "deg as (select src, count(*) as d from v7 group by src)",
        "nodes as (select p_partkey as id, p_name as title from part union all select -1 - s_suppkey, s_name from supplier)",
        "r0 as (select id, 1.0::double as rank from nodes)",
    ]
    for k in range(1, _ROUNDS + 1):
        steps.append(
            f"""r{k} as (select n.id, 0.15 + 0.85 * coalesce(c.s, 0.0) as rank from nodes n left join
            (select e.dst, sum(r.rank / deg.d) as s from v7 e join r{k - 1} r on e.src = r.id join deg on deg.src = e.src group by e.dst) c
            on n.id = c.dst)"""
        )
    return with_views(
        "v7",
        f"""with {', '.join(steps)} select n.id, n.title, round(r.rank, 6) as rank
        from nodes n join r{_ROUNDS} r on n.id = r.id order by rank desc, n.id limit 10""",
    )


@query("pagerank_top", _pagerank_sql())
def pagerank_top(spark, sf_dir):
    vertices = views.supply_vertices(spark, sf_dir)
    ranks = graph.pagerank(vertices, views.supply_links(spark, sf_dir), rounds=_ROUNDS)
    return graph.top_ranked(vertices, ranks.withColumn("rank", r6("rank")))
