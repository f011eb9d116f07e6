"""Queries over splits, samples, folds and rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions.scalars import share_limit
from stayline.functions.strings import field, split_fields
from stayline.operators import sampling
from stayline.plans.oracle_views import hash_number, with_views
from stayline.plans.registry import query
from stayline.session import cut_lineage
from stayline.sources import views
from stayline.sources.tables import table


def _classes(spark, sf_dir):
    parts = split_fields("value")
    return views.base_feature_lines(spark, sf_dir).select(field(parts, 0).cast("bigint").alias("guid"), field(parts, 1).alias("cls"))


@query("split_hash", f"""
    select event_id, case when {hash_number('event_id', 11)} >= {share_limit(0.6)} then 1 else 0 end as split from events""")
def split_hash(spark, sf_dir):
    return sampling.with_split(table(spark, sf_dir, "events").select("event_id"), "event_id", [0.6, 0.4], 11)


@query("sample_frac", f"""
    select event_id, event_type from events where {hash_number('event_id', 123)} < {share_limit(0.3)}""")
def sample_frac(spark, sf_dir):
    return sampling.sample_fraction(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 0.3, 123)


_SIZES = {"a": 300, "b": 200, "c": 100}


@query("sample_exact", with_views("v3", f"""
    select c_custkey as guid, cls from (select c_custkey, cls, row_number() over
        (partition by cls order by {hash_number('c_custkey', 888)}, c_custkey) as rn from v3)
    where rn <= case cls when 'a' then 300 when 'b' then 200 else 100 end"""))
def sample_exact(spark, sf_dir):
    return sampling.sample_exact(cut_lineage(_classes(spark, sf_dir)), "guid", "cls", _SIZES, 888)


@query("rebalance", with_views("v3", f"""
    select c_custkey as guid, cls, 1 as copy from v3 where cls <> 'a' or {hash_number('c_custkey', 123)} < {share_limit(0.3)}
    union all select c_custkey, cls, 2 from v3 where cls = 'c'"""))
def rebalance(spark, sf_dir):
    return sampling.rebalance(_classes(spark, sf_dir), "guid", "cls", {"a": 0.3, "b": 1, "c": 2}, 123)


@query("kfold", f"""
    select o_orderkey, cast({hash_number('o_orderkey', 7)} % 10 as int) as fold from orders""")
def kfold(spark, sf_dir):
    return sampling.with_fold(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 10, 7)


def _walk(step: str, before: str) -> str:
    """One walk through the grid; a value already inside stays."""
    h = lambda x, i: hash_number(x, f"5:2:{i}")
    return f"""{step} as (
        select o_orderkey, n, a, b, case when {'false' if before == 'w0' else 'v < n'} then v else l2 * b + r2 end as v from (
            select *, v // b as l0, v % b as r0, (l0 + {h('r0', 0)}) % a as l1, (r0 + {h('l1', 1)}) % b as r1,
                (l1 + {h('r1', 2)}) % a as l2, (r1 + {h('l2', 3)}) % b as r2 from {before}))"""


@query("minibatch_draw", f"""
    with r as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as v, count(*) over () as n from orders),
    g as (select *, floor(sqrt(n - 1))::bigint + 1 as a from r),
    w0 as (select *, (n + a - 1) // a as b from g), {_walk('w1', 'w0')}, {_walk('w2', 'w1')}, {_walk('w3', 'w2')}
    select o_orderkey, v // 1000 as batch, v % 1000 as place from w3""")
def minibatch_draw(spark, sf_dir):
    """The batches of one epoch: 1,000 orders each."""
    return sampling.minibatches(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1000, 5, epoch=2)
