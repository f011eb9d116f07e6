"""Queries over model training, scoring and evaluation."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayline.functions.encoding import encode_lines
from stayline.functions.scalars import share_limit
from stayline.functions.strings import field, split_fields
from stayline.operators import clusters, descent, episodes, factors, isotonic, metrics, models, neural, sampling, splits
from stayline.operators.features import minmax_scale
from stayline.plans import jobs, oracle_nets
from stayline.plans.continuity import GUID_CONTINUITY, TITLE_CONTINUITY
from stayline.plans.oracle_views import hash_number, with_views
from stayline.plans.registry import query, r6
from stayline.session import cut_lineage, scratch_path
from stayline.sources import views
from stayline.sources.tables import table

# ---- evaluation -----------------------------------------------------------------------------------

_COUNTS = """counts as (select count(case when label = 1 and pred = 1 then 1 end) as tp, count(case when label = 0 and pred = 1 then 1 end) as fp,
    count(case when label = 0 and pred = 0 then 1 end) as tn, count(case when label = 1 and pred = 0 then 1 end) as fn from v8)"""


@query("confusion", with_views("v8", f"with {_COUNTS} select tp, fp, tn, fn from counts"))
def confusion(spark, sf_dir):
    return metrics.confusion(views.scored_events(spark, sf_dir), prediction="pred")


@query("binary_metrics", with_views("v8", f"""
    with {_COUNTS} select tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) as accuracy, round(tp / (tp + fp), 6) as precision,
        round(tp / (tp + fn), 6) as recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) as f1 from counts"""))
def binary_metrics(spark, sf_dir):
    rows = metrics.binary_metrics(views.scored_events(spark, sf_dir), prediction="pred")
    return rows.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "f1")})


@query("error_rate", with_views("v8", "select round(avg(case when label <> pred then 1.0 else 0.0 end), 6) as error_rate, count(*) as n from v8"))
def error_rate(spark, sf_dir):
    return metrics.error_rate(views.scored_events(spark, sf_dir), prediction="pred").withColumn("error_rate", r6("error_rate"))


def _against_score(spark, sf_dir):
    return views.scored_events(spark, sf_dir).withColumn("prediction", F.col("score") / 100)


@query("mse", with_views("v8", "select round(avg(pow(score / 100 - label, 2)), 6) as mse, count(*) as n from v8"))
def mse(spark, sf_dir):
    return metrics.mse(_against_score(spark, sf_dir)).withColumn("mse", r6("mse"))


@query("rmse", with_views("v8", "select round(sqrt(avg(pow(score / 100 - label, 2))), 6) as rmse, count(*) as n from v8"))
def rmse(spark, sf_dir):
    return metrics.rmse(_against_score(spark, sf_dir)).withColumn("rmse", r6("rmse"))


@query("half_mse", with_views("v8", "select round(avg(pow(score / 100 - label, 2)) / 2, 6) as loss, count(*) as n from v8"))
def half_mse(spark, sf_dir):
    return metrics.half_mse(_against_score(spark, sf_dir)).withColumn("loss", r6("loss"))


@query("pred_listing", with_views("v8", """
    select id, label, round(score / 100, 6) as prediction, round(score / 100 - label, 6) as difference from v8
    order by abs(score / 100 - label) desc, id limit 200"""))
def pred_listing(spark, sf_dir):
    d = F.col("prediction") - F.col("label")
    return (
        _against_score(spark, sf_dir).select("id", "label", "prediction", d.alias("difference"))
        .orderBy(F.desc(F.abs("difference")), "id").limit(200)
        .select("id", "label", r6("prediction").alias("prediction"), r6("difference").alias("difference"))
    )


@query("auc", with_views("v8", """
    with s as (select score, sum(label) as pos, sum(1 - label) as neg from v8 group by score),
    c as (select pos, neg, sum(neg) over (order by score) - neg as below from s)
    select round(sum(pos * (below + 0.5 * neg)) / (cast(sum(pos) as double) * sum(neg)), 6) as auc,
        cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg from c"""))
def auc(spark, sf_dir):
    return metrics.auc(views.scored_events(spark, sf_dir)).withColumn("auc", r6("auc"))


# ---- gradient loops -------------------------------------------------------------------------------

_X = ["x0", "x1", "x2", "x3"]
_DATA = """d as (select 1.0::double as x0, l_quantity / 50 as x1, l_discount * 10 as x2, l_tax * 10 as x3, l_extendedprice / 100000 as y,
    case when l_returnflag = 'R' then 1.0::double else 0.0 end as b, case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as c from lineitem)"""


def _points(spark, sf_dir):
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.lit(1.0).alias("x0"), (F.col("l_quantity") / 50).alias("x1"), (F.col("l_discount") * 10).alias("x2"), (F.col("l_tax") * 10).alias("x3"),
        (F.col("l_extendedprice") / 100000).alias("y"), F.when(flag == "R", 1.0).otherwise(0.0).alias("b"),
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("c"),
    )


def _unrolled(steps: int, factor: str, update) -> str:
    """One CTE per step; ``factor`` is the row term (z is the score), ``update(t, w, g)`` the new weight."""
    parts = [_DATA, "s0 as (select " + ", ".join(f"0.0::double as w{j}" for j in range(4)) + ")"]
    for t in range(1, steps + 1):
        z = " + ".join(f"w{j} * x{j}" for j in range(4))
        new = ", ".join(f"{update(t, f'any_value(w{j})', f'avg(f * x{j})')} as w{j}" for j in range(4))
        parts.append(f"s{t} as (select {new} from (select *, {factor} as f from (select *, {z} as z from d, s{t - 1})))")
    rows = " union all ".join(f"select {j} as position, round(w{j}, 6) as weight from s{steps}" for j in range(4))
    return f"with {', '.join(parts)} {rows}"


@query("linreg_gd", _unrolled(4, "z - y", lambda t, w, g: f"{w} - {0.5 / math.sqrt(t)!r}::double * {g}"))
def linreg_gd(spark, sf_dir):
    fit = descent.linear(_points(spark, sf_dir), _X, "y", steps=4, step=0.5)
    return fit.weight_table(spark).withColumn("weight", r6("weight"))


@query("logreg_gd", _unrolled(4, "b - 1 / (1 + exp(-z))", lambda t, w, g: f"{w} + 0.5::double * {g}"))
def logreg_gd(spark, sf_dir):
    fit = descent.logistic(_points(spark, sf_dir), _X, "b", steps=4, rate=0.5)
    return fit.weight_table(spark).withColumn("weight", r6("weight"))


def _svm_update(t, w, g):
    rate = 1.0 / math.sqrt(t)
    moved = f"({w} - {rate!r}::double * {g})"
    return f"sign({moved}) * greatest(abs({moved}) - {0.1 * rate!r}::double, 0.0)"


@query("svm_l1_gd", _unrolled(4, "case when (2 * b - 1) * z < 1 then -(2 * b - 1) else 0.0 end", _svm_update))
def svm_l1_gd(spark, sf_dir):
    fit = descent.svm_l1(_points(spark, sf_dir), _X, "b", steps=4)
    return fit.weight_table(spark).withColumn("weight", r6("weight"))


_W = [[0.1, -0.2, 0.3, 0.05], [-0.1, 0.4, 0.2, -0.3]]
_M1, _M2 = (" + ".join(f"{v}::double * x{j}" for j, v in enumerate(w)) for w in _W)


@query("logloss_grad", f"""
    with {_DATA}, m as (select *, {_M1} as m1, {_M2} as m2 from d), p as (select *, ln(1 + exp(m1) + exp(m2)) as lse from m)
    select count(*) as n, round(sum(lse - case c when 1 then m1 when 2 then m2 else 0.0 end), 4) as loss, """
    + ", ".join(f"round(sum((exp(m{i} - lse) - case when c = {i} then 1 else 0 end) * x{j}), 4) as g{i}_{j}" for i in (1, 2) for j in range(4)) + " from p")
def logloss_grad(spark, sf_dir):
    rows = descent.multinomial_loss(_points(spark, sf_dir), _X, "c", _W)
    return rows.select("n", *[F.round(c, 4).alias(c) for c in rows.columns if c != "n"])


@query("linreg_closed", """
    select round(regr_slope(l_extendedprice, l_quantity), 6) as slope, round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
        count(*) as n from lineitem""")
def linreg_closed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        r6(F.regr_slope("l_extendedprice", "l_quantity")).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"), F.count(F.lit(1)).alias("n"),
    )


# ---- table-form models ----------------------------------------------------------------------------

_NB = [f"f{i}" for i in range(1, 9)]


def _nb_sql() -> str:
    """Tokens that stand for no number count as 0, values below 0 as 0, f2 is clamped as in the file layout."""
    clean = ", ".join(f"greatest({c}, 0) as {c}" for c in _NB if c != "f2")
    sums = ", ".join(f"sum({c}) as c{c[1:]}" for c in _NB)
    total = " + ".join(f"c{c[1:]}" for c in _NB)
    weights = ", ".join(f"ln((c{c[1:]} + 1) / ({total} + {len(_NB)})) as w{c[1:]}" for c in _NB)
    score = " + ".join(f"w{c[1:]} * t.{c}" for c in _NB)
    parts = [
        "t as (select c_custkey, case cls when 'a' then 0 when 'b' then 1 else 2 end as label, "
        f"case when spend_token <> '' then 0 else greatest(least(f2, 1e8), 0) end as f2, {clean} from v3)",
        f"k as (select label, count(*) as n, {sums} from t group by label)",
        f"m as (select label, ln((n + 1.0) / (sum(n) over () + count(*) over ())) as p, {weights} from k)",
        "s as (select c_custkey, t.label, " + ", ".join(f"(select p + {score} from m where m.label = {i}) as s{i}" for i in range(3)) + " from t)",
    ]
    return with_views("v3", f"""with {', '.join(parts)} select c_custkey as guid, label, round(s0, 3) as s0, round(s1, 3) as s1, round(s2, 3) as s2,
        case when s0 >= greatest(s1, s2) then 0 when s1 >= greatest(s0, s2) then 1 else 2 end as prediction from s""")


@query("nb_sql", _nb_sql())
def nb_sql(spark, sf_dir):
    parts = split_fields("value")
    lines = views.base_feature_lines(spark, sf_dir).withColumn("cls", field(parts, 1))
    points = encode_lines(lines, "churn", key=True, drop_last=True, keep=["cls"])
    label = F.when(F.col("cls") == "a", 0).when(F.col("cls") == "b", 1).otherwise(2).alias("label")
    rows = points.select(F.col("guid").cast("bigint").alias("guid"), label, *[F.greatest(F.get("features", F.lit(i)), F.lit(0.0)).alias(c) for i, c in enumerate(_NB)])
    scored = models.naive_bayes_score(rows, models.naive_bayes_table(rows, "label", _NB), _NB)
    return scored.select("guid", "label", *[F.round(f"s{i}", 3).alias(f"s{i}") for i in range(3)], "prediction")


@query("isotonic_minmax", """
    with p as (select l_quantity as x, avg(l_extendedprice) as y, cast(count(*) as double) as w from lineitem group by 1),
    c as (select x, y, w, sum(w * y) over (order by x) as sy, sum(w) over (order by x) as sw from p),
    b as (select j.x as a, k.x as z, (k.sy - j.sy + j.w * j.y) / (k.sw - j.sw + j.w) as mean from c j join c k on j.x <= k.x),
    f as (select i.x, b.a, min(b.mean) as low from c i join b on b.a <= i.x and b.z >= i.x group by i.x, b.a)
    select p.x, round(p.y, 4) as y, p.w, round(max(f.low), 4) as fit from p join f on p.x = f.x group by p.x, p.y, p.w""")
def isotonic_minmax(spark, sf_dir):
    rows = isotonic.fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return rows.select("x", F.round("y", 4).alias("y"), "w", F.round("fit", 4).alias("fit"))


# the fit is the slope of the greatest convex minorant of the prefix sums: from each corner the next one is where the slope is least
_MINORANT = """c as materialized (
        select row_number() over (order by x) as i, x, y, w, sum(w * y) over (order by x) as sy, sum(w) over (order by x) as sw from p
    ), g(i, sy, sw, fit) as (
        select 0::bigint, 0.0::double, 0.0::double, null::double
        union all
        select m.i, m.sy, m.sw, m.slope from (
            select arg_min({'i': c.i, 'sy': c.sy, 'sw': c.sw, 'slope': (c.sy - g.sy) / (c.sw - g.sw)}, (c.sy - g.sy) / (c.sw - g.sw)) as m
            from g join c on c.i > g.i having count(*) > 0)
    ), fits as (
        select c.x, c.y, c.w, g.fit from c asof join (select * from g where i > 0) g on c.i <= g.i
    )"""


@query("isotonic_continuous", f"""
    with recursive p as (
        select o_totalprice as x, avg(n) as y, cast(count(*) as double) as w
        from orders join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey group by 1
    ), {_MINORANT} select x, round(y, 6) as y, w, round(fit, 6) as fit from fits""")
def isotonic_continuous(spark, sf_dir):
    """Items of an order over its price: nearly every row has an x of its own."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows = isotonic.fit(orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")), "o_totalprice", "n", most=500)
    return rows.select("x", r6("y").alias("y"), "w", r6("fit").alias("fit"))


_CENTRES = [[((k * 5 + j * 3) % 7 - 3) / 20 for j in range(64)] for k in range(4)]
_ASSIGN = "dist as (select vec_id, " + ", ".join(
    f"list_sum(list_transform(range(0, 64), lambda j: pow(x[j + 1] - (({k} * 5 + j * 3) % 7 - 3) / 20.0::double, 2))) as d{k}" for k in range(4)
) + " from v6), near as (select vec_id, least(d0, d1, d2, d3) as distance, case least(d0, d1, d2, d3) when d0 then 0 when d1 then 1 when d2 then 2 else 3 end as cluster from dist)"


@query("kmeans_assign", with_views("v6", f"with {_ASSIGN} select vec_id, cluster, round(distance, 6) as distance from near"))
def kmeans_assign(spark, sf_dir):
    rows = models.assign_nearest(views.vectors(spark, sf_dir), "x", _CENTRES)
    return rows.select("vec_id", "cluster", r6("distance").alias("distance"))


@query("kmeans_cost", with_views("v6", f"with {_ASSIGN} select round(sum(distance), 6) as cost, count(*) as n from near"))
def kmeans_cost(spark, sf_dir):
    rows = models.assign_nearest(views.vectors(spark, sf_dir), "x", _CENTRES)
    return metrics.nearest_cost(rows, "distance").withColumn("cost", r6("cost"))


_APART = "list_sum(list_transform(list_zip(x, c), lambda z: pow(z[1] - z[2], 2)))"


def _lloyd_sql(rounds: int) -> str:
    """a0, c1, a1, …: the nearest centre of each vector, and the means of the vectors of each centre."""
    steps = ["c0 as (select k, list_transform(range(0, 64), lambda j: ((k * 5 + j * 3) % 7 - 3) / 20.0::double) as c from range(4) t(k))"]
    for i in range(rounds + 1):
        steps.append(f"a{i} as materialized (select vec_id, any_value(x) as x, arg_min(k, {_APART}) as k, min({_APART}) as d from v6, c{i} group by vec_id)")
        if i < rounds:
            steps.append(
                f"m{i} as (select k, list(v order by j) as c from (select k, j, avg(v) as v from (select k, unnest(x) as v, generate_subscripts(x, 1) as j from a{i}) group by k, j) group by k), "
                f"c{i + 1} as materialized (select c.k, coalesce(m.c, c.c) as c from c{i} c left join m{i} m on c.k = m.k)"
            )
    return ", ".join(steps)


@query("kmeans_rounds", with_views("v6", f"""
    with {_lloyd_sql(2)}, s as (select k, count(*) as n, sum(d) as cost from a2 group by k)
    select cast(c.k as int) as cluster, cast(j - 1 as int) as position, round(c[j], 8) as value, coalesce(n, 0) as n, round(coalesce(cost, 0), 6) as cost,
        round((select sum(d) from a0), 6) as cost_before from c2 c left join s on s.k = c.k, range(1, 65) t(j)"""))
def kmeans_rounds(spark, sf_dir):
    """Centres, sizes and costs after two rounds from given centres."""
    found = clusters.lloyd(views.vectors(spark, sf_dir), "x", np.array(_CENTRES), rounds=2)
    rows = found.table(spark).select("cluster", F.posexplode("centre").alias("position", "value"), "n", r6("cost").alias("cost"))
    return rows.withColumns({"value": F.round("value", 8), "cost_before": F.round(F.lit(found.history[0]), 6)})


# ---- split search ------------------------------------------------------------------------------------

_SPLIT_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_BINS = 16


def _levels_sql(label: str, sums: dict[str, str], impurity: Callable[[list[str]], str], rows: Callable[[list[str]], str]) -> str:
    """The best split of the root, then of both children: every bound of every feature is tried.

    ``sums`` are aggregates with a place for a filter; ``impurity`` (times rows) and ``rows`` are written in terms of their names.
    """
    names = list(sums)
    l, r = ([side + n for n in names] for side in "lr")
    totals = ", ".join(f"cast({f.format('true')} as double) as {n}" for n, f in sums.items())
    left = ", ".join(f"cast({f.format('v <= t')} as double) as l{n}" for n, f in sums.items())
    both = ", ".join(f"coalesce(l{n}, 0) as l{n}, {n} - coalesce(l{n}, 0) as r{n}" for n in names)
    pick = lambda f: f"case {f} {' '.join(f'when {k} then {c}' for k, c in enumerate(_SPLIT_FEATURES))} end"
    ends = " union all ".join(f"select {k} as f, min({c}) as lo, max({c}) as hi from lineitem" for k, c in enumerate(_SPLIT_FEATURES))

    def level(i: int) -> str:
        return f"""e{i} as (select node, y, f, {pick('f')} as v from r{i}, range({len(_SPLIT_FEATURES)}) q(f)),
    w{i} as (select node, {totals} from r{i} group by node),
    t{i} as (select node, e.f, t, {left} from e{i} e join bounds on e.f = bounds.f group by node, e.f, t),
    z{i} as (select node, f, t, {', '.join(names)}, {both} from t{i} join w{i} using (node)),
    g{i} as (select node, f, t, {rows(names)} as total, {rows(l)} as below, ({impurity(names)} - {impurity(l)} - {impurity(r)}) / ({rows(names)}) as gain
        from z{i} where {rows(l)} > 0 and {rows(r)} > 0),
    b{i} as (select cast({i} as int) as level, cast(node as bigint) as node, cast(f as int) as feature, t as threshold, gain, cast(total as bigint) as n, cast(below as bigint) as left_n
        from g{i} where gain > 1e-12 qualify row_number() over (partition by node order by round(gain, 9) desc, f, t) = 1)"""

    return f"""with r1 as (select 1 as node, {label} as y, {', '.join(_SPLIT_FEATURES)} from lineitem),
    bounds as (select f, lo + (hi - lo) * b / {_BINS} as t from ({ends}), range(1, {_BINS}) q(b)), {level(1)},
    r2 as (select 2 + case when {pick('b1.feature')} > b1.threshold then 1 else 0 end as node, y, {', '.join(_SPLIT_FEATURES)} from r1, b1), {level(2)}
    select level, node, feature, round(threshold, 6) as threshold, round(gain, 6) as gain, n, left_n from (select * from b1 union all select * from b2)"""


def _split_rows(spark, sf_dir, label):
    return table(spark, sf_dir, "lineitem").select(label.alias("label"), F.array(*_SPLIT_FEATURES).alias("features"))


def _two_levels(rows, classes):
    bounds = splits.width_bounds(rows, "features", len(_SPLIT_FEATURES), _BINS)
    found = splits.grow(rows, "label", "features", bounds, depth=2, classes=classes)
    return found.select("level", "node", "feature", r6("threshold").alias("threshold"), r6("gain").alias("gain"), "n", "left_n")


@query("tree_level", _levels_sql(
    "case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end", {f"s{c}": f"count(*) filter (where y = {c} and {{}})" for c in range(3)},
    lambda s: f"(({' + '.join(s)}) - ({' + '.join(f'{c} * {c}' for c in s)}) / ({' + '.join(s)}))", lambda s: f"({' + '.join(s)})",
))
def tree_level(spark, sf_dir):
    """The first two levels' splits for three classes."""
    flag = F.col("l_returnflag")
    return _two_levels(_split_rows(spark, sf_dir, F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)), 3)


@query("tree_level_reg", _levels_sql(
    "l_linenumber + l_quantity", {"n": "count(*) filter (where {})", "s": "sum(y) filter (where {})", "q": "sum(y * y) filter (where {})"},
    lambda s: f"({s[2]} - {s[1]} * {s[1]} / {s[0]})", lambda s: s[0],
))
def tree_level_reg(spark, sf_dir):
    """The same for a number, by variance."""
    return _two_levels(_split_rows(spark, sf_dir, F.col("l_linenumber") + F.col("l_quantity")), None)


# ---- trained models -------------------------------------------------------------------------------


def _customer_points(spark, sf_dir):
    lines = views.base_feature_lines(spark, sf_dir)
    return encode_lines(lines, "churn", key=True, drop_last=True).select(F.col("guid").cast("bigint").alias("guid"), "label", "features")


# Trained models are compared by what SQL can know exactly: how many rows are scored, how many are positive, and that the
# quality meets the bound stated at the query.
_TEST = f"{hash_number('c_custkey', 11)} >= {share_limit(0.6)}"
_GRADED = with_views("v3", f"""
    select count(*) as n, cast(sum(case when cls <> 'a' then 1 else 0 end) as bigint) as positives, true as good from v3 where {_TEST}""")


def _graded(scored, good):
    """One row: rows scored, positive rows, and whether a condition on aggregates holds."""
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("positives"), good.alias("good"))


def _accurate(bound):
    return F.avg(F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)) >= bound


def _close(bound):
    """Mean squared error within a multiple of the label's variance."""
    return F.avg(metrics.squared_error("label", "prediction")) <= bound * F.var_pop("label")


def _train_and_score(spark, sf_dir, estimator, nonnegative=False):
    """60/40 split by guid, fit on the first part, score the second."""
    train, test = sampling.random_split(_customer_points(spark, sf_dir), "guid", [0.6, 0.4], 11)
    model = models.fit(estimator, models.as_vectors(train, nonnegative=nonnegative), "guid")
    return model.transform(models.as_vectors(test, nonnegative=nonnegative))


@query("ml_decision_tree", _GRADED)
def ml_decision_tree(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.decision_tree(depth=5, bins=32)), _accurate(0.9))


@query("ml_random_forest", _GRADED)
def ml_random_forest(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.random_forest(trees=20, depth=10, bins=20)), _accurate(0.7))


@query("ml_gbt", _GRADED)
def ml_gbt(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.boosted_trees(rounds=20, depth=10)), _accurate(0.9))


# the columns as the trainers see them: tokens that stand for no number count as 0, large values are clamped
_POINTS = "t as (select c_custkey as guid, case when cls = 'a' then 0.0::double else 1.0::double end as label, [" + ", ".join(
    "case when spend_token <> '' then 0 else least(f2, 1e8) end" if c == "f2" else c for c in _NB
) + f"]::double[] as f, {_TEST} as tested from v3)"


def _bayes_sql() -> str:
    low = "list_transform(f, lambda v: greatest(v, 0))"
    return with_views("v3", f"""
    with {_POINTS}, s as (select label, k, sum(v) as v from (select label, unnest({low}) as v, generate_subscripts(f, 1) as k from t where not tested) group by label, k),
    n as (select label, count(*) as n from t where not tested group by label),
    w as (select label, list(ln(v + 1.0) - ln(total + {len(_NB)}.0) order by k) as w from (select *, sum(v) over (partition by label) as total from s) group by label),
    m as (select label, w, ln(n + 1.0) - ln(sum(n) over () + count(*) over ()) as p from w join n using (label)),
    e as (select guid, t.label, m.label as class, p + list_inner_product({low}, w) as score from t, m where tested)
    select guid, cast(any_value(label) as int) as label, round(max(score) filter (where class = 0), 3) as s0, round(max(score) filter (where class = 1), 3) as s1, arg_max(class, score) as prediction from e group by guid""")


@query("ml_naive_bayes", _bayes_sql())
def ml_naive_bayes(spark, sf_dir):
    """Log joints and predictions of the test rows."""
    scored = _train_and_score(spark, sf_dir, models.naive_bayes(), nonnegative=True)
    raw = vector_to_array("rawPrediction")
    return scored.select("guid", F.col("label").cast("int").alias("label"), F.round(F.get(raw, F.lit(0)), 3).alias("s0"), F.round(F.get(raw, F.lit(1)), 3).alias("s1"), "prediction")


@query("ml_svm", _GRADED)
def ml_svm(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.linear_svm(steps=100)), _accurate(0.6))


@query("ml_logreg", _GRADED)
def ml_logreg(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.logistic_regression()), _accurate(0.6))


@query("model_auc", _GRADED)
def model_auc(spark, sf_dir):
    """The area under the curve of a boosted model's raw scores on the test rows."""
    scored = _train_and_score(spark, sf_dir, models.boosted_trees(rounds=5, depth=5))
    scored = scored.select("guid", "label", "prediction", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"))
    area = metrics.auc(scored.select("label", "score")).first()["auc"]
    return _graded(scored, F.lit(area >= 0.9))


@query("cross_validate", with_views("v3", f"""
    select cast({hash_number('c_custkey', 7)} % 10 as int) as fold, count(*) as n, true as good from v3 group by 1"""))
def cross_validate(spark, sf_dir):
    """Ten folds: train on nine, score the tenth."""
    scored = None
    for i, (train, test) in enumerate(sampling.folds(_customer_points(spark, sf_dir), "guid", 10, 7)):
        model = models.fit(models.decision_tree(depth=5), models.as_vectors(train), "guid")
        part = model.transform(models.as_vectors(test)).select(F.lit(i).alias("fold"), "label", "prediction")
        scored = part if scored is None else scored.union(part)
    return scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), _accurate(0.7).alias("good"))


@query("ml_logreg_history", "select true as falling, true as several")
def ml_logreg_history(spark, sf_dir):
    """The loss never rises from one step to the next."""
    model = models.fit(models.logistic_regression_lbfgs(), models.as_vectors(_customer_points(spark, sf_dir)), "guid")
    steps = models.objective_history(model)
    moved = steps.withColumn("up", F.col("loss") - F.lag("loss").over(Window.orderBy("step")))
    return moved.agg((F.max("up") <= 1e-9).alias("falling"), (F.count("up") > 1).alias("several"))


def _linreg_sql() -> str:
    """The normal equations of scaled columns, eliminated column by column."""
    k = len(_NB)
    scaled = "list_transform(range(1, {n}), lambda i: (f[i] - mean[i]) / dev[i])".format(n=k + 1)
    steps = [f"e0 as materialized (select i, j, sum(z[i] * z[j]) as v from z, range(1, {k + 1}) a(i), range(1, {k + 2}) b(j) where not tested group by i, j)"]
    for p in range(1, k + 1):
        steps.append(f"""e{p} as materialized (select m.i, m.j, case when m.i = {p} then m.v / p.v else m.v - c.v * r.v / p.v end as v from e{p - 1} m
        join e{p - 1} p on p.i = {p} and p.j = {p} join e{p - 1} c on c.i = m.i and c.j = {p} join e{p - 1} r on r.i = {p} and r.j = m.j)""")
    return with_views("v3", f"""
    with {_POINTS}, u as (select k, avg(v) as mean, stddev_samp(v) as dev from (select unnest(f) as v, generate_subscripts(f, 1) as k from t where not tested) group by k),
    l as (select list(mean order by k) as mean, list(dev order by k) as dev, (select avg(label) from t where not tested) as middle from u),
    z as materialized (select guid, label, tested, list_append({scaled}, label - middle) as z from t, l), {', '.join(steps)},
    w as (select list(v order by i) as w from e{k} where j = {k + 1})
    select guid, cast(label as int) as label, round(middle + list_inner_product(z[1:{k}], w), 5) as prediction from z, w, l where tested""")


@query("ml_linreg", _linreg_sql())
def ml_linreg(spark, sf_dir):
    """Predictions of the test rows."""
    scored = _train_and_score(spark, sf_dir, models.linear_regression())
    return scored.select("guid", F.col("label").cast("int").alias("label"), F.round("prediction", 5).alias("prediction"))


@query("ml_tree_reg", _GRADED)
def ml_tree_reg(spark, sf_dir):
    return _graded(_train_and_score(spark, sf_dir, models.tree_regressor(depth=5, bins=100)), _close(0.4))


@query("ml_mlp", _GRADED)
def ml_mlp(spark, sf_dir):
    names = [f"f{i}" for i in range(8)]
    rows = _customer_points(spark, sf_dir).select("guid", "label", *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(names)])
    rows = minmax_scale(rows, names).select("guid", "label", F.array(*names).alias("features"))
    train, test = sampling.random_split(rows, "guid", [0.6, 0.4], 11)
    model = models.fit(models.multilayer_perceptron([8, 5, 2]), models.as_vectors(train), "guid")
    return _graded(model.transform(models.as_vectors(test)), _accurate(0.55))


_ISOTONIC_SIDE = f"{hash_number('o_orderkey', 11)} {{}} {share_limit(0.6)}"


@query("ml_isotonic", f"""
    with recursive o as (select *, cast(floor(o_custkey / 10) as double) as x from orders), p as (
        select x, avg(o_totalprice) as y, cast(count(*) as double) as w from o where {_ISOTONIC_SIDE.format('<')} group by 1
    ), {_MINORANT}, t as (
        select o_orderkey, o_totalprice as y, o.x, l.x as x0, l.fit as f0 from o asof left join fits l on o.x >= l.x where {_ISOTONIC_SIDE.format('>=')}
    ), u as (
        select t.*, r.x as x1, r.fit as f1 from t asof left join fits r on t.x <= r.x
    ) select o_orderkey, y, round(case when x0 is null then f1 when x1 is null or x1 = x0 then f0 else f0 + (f1 - f0) * (x - x0) / (x1 - x0) end, 4) as fit from u""")
def ml_isotonic(spark, sf_dir):
    """Every test row is scored, also those whose x the training rows lack: linear between its neighbours."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("y"), F.floor(F.col("o_custkey") / 10).cast("double").alias("x"))
    train, test = sampling.random_split(orders, "o_orderkey", [0.6, 0.4], 11)
    scored = isotonic.predict(isotonic.fit(train, "x", "y"), test, "x")
    return scored.select("o_orderkey", "y", F.round("fit", 4).alias("fit"))


@query("ml_kmeans", "select count(*) as n, 3 as clusters, true as good from embeddings")
def ml_kmeans(spark, sf_dir):
    """Trained centres cost less than the mean of all vectors does."""
    rows = models.as_vectors(views.vectors(spark, sf_dir), "x").withColumnRenamed("x", "features")
    model = models.fit(models.kmeans(k=3, steps=20), rows, "vec_id")
    spread = rows.agg(Summarizer.variance(F.col("features")).alias("v"), F.count(F.lit(1)).alias("n")).first()
    cheaper = bool(model.summary.trainingCost < float(sum(spread["v"].toArray())) * (spread["n"] - 1))
    return model.transform(rows).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("prediction").cast("int").alias("clusters"), F.lit(cheaper).alias("good"))


def _rated(spark, sf_dir):
    return views.ratings(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("user"), F.col("item").cast("int").alias("item"), F.col("rating").cast("float").alias("rating")
    )


@query("ml_als", with_views("v5", "select count(*) as n, true as good from v5"))
def ml_als(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = models.fit_factors(models.als(rank=10, steps=20, reg=0.01), rows, "user")
    scored = model.transform(rows)
    return scored.agg(F.count(F.lit(1)).alias("n"), (F.avg(metrics.squared_error("rating", "prediction")) <= 0.5 * F.var_pop("rating")).alias("good"))


@query("ml_als_implicit", with_views("v5", "select count(*) as n, true as good from v5"))
def ml_als_implicit(spark, sf_dir):
    rows = _rated(spark, sf_dir)
    model = models.fit_factors(models.als_implicit(rank=10, steps=20), rows, "user")
    return model.transform(rows).agg(F.count(F.lit(1)).alias("n"), (F.avg("prediction") > 0).alias("good"))


# ---- factors as tables: rank 1 has a closed form, which SQL unrolls ------------------------------------

_REG = 0.05


def _sweeps_sql(sweeps: int) -> str:
    """u1, i1, u2, …: factors of users and items after each half step, from draws of the item ids."""
    steps = [f"i0 as (select item as id, {hash_number('item', '1:0')} / 4294967296.0::double as f from (select distinct item from v5))"]
    for n in range(1, sweeps + 1):
        for side, key, other, ids in (("u", "user_id", "item", f"i{n - 1}"), ("i", "item", "user_id", f"u{n}")):
            steps.append(
                f"{side}{n} as materialized (select {key} as id, sum(rating * f) / (sum(f * f) + {_REG} * count(*)) as f from v5 join {ids} s on s.id = v5.{other} group by {key})"
            )
    return ", ".join(steps)


def _rated_long(spark, sf_dir):
    return views.ratings(spark, sf_dir).withColumnRenamed("user_id", "user")


@query("als_half_step", with_views("v5", f"with {_sweeps_sql(1)} select id, round(f, 6) as factor from u1"))
def als_half_step(spark, sf_dir):
    """User factors of rank 1 from the start factors of the items."""
    rows, settings = cut_lineage(_rated_long(spark, sf_dir)), factors.Settings(rank=1, reg=_REG)
    links = factors.Links(rows, "user", "item", settings, factors.blocks(rows, settings, 8))
    start = factors.initial(rows.select(F.col("item").alias("id")).distinct(), settings)
    found = cut_lineage(factors.half_step(links, start, settings))
    links.drop()
    return found.select("id", r6(F.col("factors")[0]).alias("factor"))


_SWEPT = "select sqrt(avg(pow(rating - u3.f * i3.f, 2))) as rmse, count(*) as n from v5 join u3 on u3.id = user_id join i3 on i3.id = item"


@query("als_sweeps", with_views("v5", f"""
    with {_sweeps_sql(3)}, e as ({_SWEPT})
    select 'user' as side, id, round(f, 5) as factor, round(rmse, 5) as rmse from u3, e union all select 'item', id, round(f, 5), round(rmse, 5) from i3, e"""))
def als_sweeps(spark, sf_dir):
    """All factors after three sweeps, and the error over all ratings."""
    rows = _rated_long(spark, sf_dir)
    model = factors.train(rows, factors.Settings(rank=1, reg=_REG), sweeps=3)
    sides = model.users.withColumn("side", F.lit("user")).unionByName(model.items.withColumn("side", F.lit("item")))
    return sides.join(F.broadcast(model.error(rows)), F.lit(True)).select(
        "side", "id", F.round(F.col("factors")[0], 5).alias("factor"), F.round("rmse", 5).alias("rmse")
    )


@query("als_roundtrip", with_views("v5", f"""
    with {_sweeps_sql(3)}, e as ({_SWEPT}) select unnest(['before', 'after']) as model, n, round(rmse, 5) as rmse from e"""))
def als_roundtrip(spark, sf_dir):
    """The error of a model, and of the same one saved and loaded."""
    rows, path = _rated_long(spark, sf_dir), scratch_path(spark, "factors")
    model = factors.train(rows, factors.Settings(rank=1, reg=_REG), sweeps=3)
    model.save(path)
    both = {"before": model, "after": factors.Factors.load(spark, path)}
    parts = [m.error(rows).select(F.lit(name).alias("model"), "n", F.round("rmse", 5).alias("rmse")) for name, m in both.items()]
    return parts[0].unionByName(parts[1])


@query("text_classifier", """
    select (select count(*) from documents) as n, count(*) as labelled, true as good from labels join documents using (doc_id)""")
def text_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = models.fit(models.text_stages(), docs.join(labels, "doc_id"), "doc_id")
    scored = model.transform(docs).select("doc_id", "prediction").join(labels, "doc_id", "left")
    hit = F.when(F.col("label") == F.col("prediction"), 1.0).when(F.col("label").isNotNull(), 0.0)
    return scored.agg(F.count("prediction").alias("n"), F.count("label").alias("labelled"), (F.avg(hit) >= 0.9).alias("good"))


@query("model_roundtrip", with_views("v3", "select c_custkey as guid, true as same from v3"))
def model_roundtrip(spark, sf_dir):
    points = models.as_vectors(_customer_points(spark, sf_dir))
    model = Pipeline(stages=[models.decision_tree()]).fit(points)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    before = model.transform(points).select("guid", F.col("probability").alias("p"))
    after = models.load_model(path).transform(before.join(points, "guid"))
    return after.select("guid", (vector_to_array("p") == vector_to_array("probability")).alias("same"))


# ---- networks -------------------------------------------------------------------------------------


def _samples(spark, sf_dir):
    return views.vectors(spark, sf_dir).select(
        F.col("vec_id").alias("id"), F.array(F.col("label") / 10).alias("label"), F.col("x").alias("features")
    )


_UNIT = [0.1] + [((j * 3) % 7 - 3) / 10 for j in range(64)]


@query("nn_gradient", with_views("v6", """
    with a as (select x, label / 10 as y, 1 / (1 + exp(-(0.1 + list_inner_product(x, list_transform(range(0, 64), lambda j: ((j * 3) % 7 - 3) / 10.0::double))))) as o from v6),
    d as (select list_prepend(1.0::double, x) as x, -(y - o) * o * (1 - o) as d from a)
    select cast(i - 1 as int) as position, round(avg(d * x[i]), 6) as v from d, range(1, 66) t(i) group by i"""))
def nn_gradient(spark, sf_dir):
    cfg = neural.NetConfig((64, 1), output="sigmoid")
    grads, _, _ = neural.net_gradient(_samples(spark, sf_dir), cfg, [np.array([_UNIT])])
    rows = [(j, float(v)) for j, v in enumerate(grads[0][0])]
    return spark.createDataFrame(rows, "position int, v double").withColumn("v", r6("v"))


def _deep(layer, i, j):
    """Weights of a net with two hidden layers; the same rule in SQL below."""
    return ((5 * i + 3 * j + layer) % 7 - 3) / 10


def _deep_units(layer, inputs, width, below):
    row = "list_transform(range(0, {n}), lambda j: ((5 * {i} + 3 * j + {l}) % 7 - 3) / 10.0::double)"
    return "[" + ", ".join(f"1 / (1 + exp(-list_inner_product({below}, {row.format(n=inputs, i=i, l=layer)})))" for i in range(width)) + "]"


_RULE = "((5 * {i} + 3 * {j} + {l}) % 7 - 3) / 10.0::double"


@query("nn_gradient_deep", with_views("v6", f"""
    with l0 as (select list_prepend(1.0::double, x) as x, label / 10 as y from v6),
    l1 as (select *, list_prepend(1.0::double, {_deep_units(0, 65, 3, 'x')}) as a from l0),
    l2 as (select *, list_prepend(1.0::double, {_deep_units(1, 4, 2, 'a')}) as b from l1),
    l3 as (select *, {_deep_units(2, 3, 1, 'b')}[1] as o from l2),
    d3 as (select *, -(y - o) * o * (1 - o) as e3 from l3),
    d2 as (select *, [{', '.join(f"e3 * {_RULE.format(i=0, j=k + 1, l=2)} * b[{k + 2}] * (1 - b[{k + 2}])" for k in range(2))}] as e2 from d3),
    d1 as (select *, [{', '.join('(' + ' + '.join(f"e2[{k + 1}] * {_RULE.format(i=k, j=m + 1, l=1)}" for k in range(2)) + f') * a[{m + 2}] * (1 - a[{m + 2}])' for m in range(3))}] as e1 from d2),
    g as (select 0 as layer, i - 1 as i, j - 1 as j, avg(e1[i] * x[j]) as v from d1, range(1, 4) p(i), range(1, 66) q(j) group by i, j
        union all select 1, i - 1, j - 1, avg(e2[i] * a[j]) from d1, range(1, 3) p(i), range(1, 5) q(j) group by i, j
        union all select 2, 0, j - 1, avg(e3 * b[j]) from d1, range(1, 4) q(j) group by j)
    select cast(layer as int) as layer, cast(i as int) as i, cast(j as int) as j, round(v, 8) as v from g"""))
def nn_gradient_deep(spark, sf_dir):
    """The mean gradient of all three weight matrices."""
    cfg = neural.NetConfig((64, 3, 2, 1), hidden="sigmoid", output="sigmoid")
    weights = [np.array([[_deep(n, i, j) for j in range(a + 1)] for i in range(b)]) for n, (a, b) in enumerate(zip(cfg.size, cfg.size[1:]))]
    grads, _, _ = neural.net_gradient(_samples(spark, sf_dir), cfg, weights)
    rows = [(n, i, j, float(v)) for n, g in enumerate(grads) for (i, j), v in np.ndenumerate(g)]
    return spark.createDataFrame(rows, "layer int, i int, j int, v double").withColumn("v", F.round("v", 8))


@query("nn_train", "select count(*) as n, true as good from embeddings")
def nn_train(spark, sf_dir):
    """Every row is scored inside the output's range, and the loss after training is finite and below a half."""
    cfg = neural.NetConfig((64, 6, 1), hidden="scaled_tanh", output="sigmoid", rate=0.5, momentum=0.5, rate_decay=0.99)
    samples = _samples(spark, sf_dir)
    model = neural.net_train(samples, cfg, batch_rows=max(1, samples.count() // 3), epochs=2, validation=0.2)
    scored = model.predict(samples)
    return scored.agg(F.count(F.lit(1)).alias("n"), (F.min(F.col("prediction")[0]).between(0, 1) & F.lit(model.history[-1]["train"] < 0.5)).alias("good"))


@query("net_roundtrip", "select vec_id, true as same from embeddings")
def net_roundtrip(spark, sf_dir):
    """Every prediction of a saved and loaded net is that of the net itself, and so is the loss."""
    samples, path = _samples(spark, sf_dir), scratch_path(spark, "net")
    cfg = neural.NetConfig((64, 4, 1), hidden="sigmoid", output="sigmoid", rate=0.5)
    model = neural.net_train(samples, cfg, batch_rows=samples.count(), epochs=1)
    model.save(spark, path)
    again = neural.NetModel.load(spark, path, cfg)
    equal = F.lit(model.loss(samples) == again.loss(samples))
    both = again.predict(model.predict(samples, "before"), "after")
    return both.select(F.col("id").alias("vec_id"), (equal & (F.col("before") == F.col("after"))).alias("same"))


_NET_ROWS = "net as (select vec_id as id, list_prepend(1.0::double, x) as x, label / 10 as y from v6)"


def _net_weights(spark, model):
    """Weights and losses of a trained net as rows."""
    losses = spark.createDataFrame([("loss", 0, h["epoch"], float(h["train"])) for h in model.history], neural.PARTIALS)
    return model.weight_table(spark).unionByName(losses).select("kind", "i", "j", F.round("v", 8).alias("v"))


@query("nn_backprop", with_views("v6", f"""
    with {_NET_ROWS}, {', '.join(oracle_nets.two_layers('net', 64, 9, 3, 0.1))}
    select 'w0' as kind, cast(k - 1 as int) as i, cast(j - 1 as int) as j, round(w0[k][j], 8) as v from n3, range(1, 10) p(k), range(1, 66) q(j)
    union all select 'w1', 0, cast(j - 1 as int), round(w1[j], 8) from n3, range(1, 11) q(j)
    union all {' union all '.join(f"select 'loss', 0, {i}, round(0.5 * avg(pow(y - o, 2)), 8) from o{i}" for i in (1, 2, 3))}"""))
def nn_backprop(spark, sf_dir):
    """All weights after three full-batch steps, and the loss after each."""
    samples = _samples(spark, sf_dir)
    # the stop rule is on the mean squared error, twice the half mean that the history holds
    return _net_weights(spark, neural.net_train(samples, neural.backprop_preset(64), batch_rows=samples.count(), epochs=3, stop_loss=0.005))


@query("nn_momentum", with_views("v6", f"""
    with {_NET_ROWS}, {', '.join(oracle_nets.two_layers('net', 64, 6, 2, 0.5, 0.5, 0.9, 'scaled_tanh'))}
    select id as vec_id, y as label, round(o, 8) as prediction from o2"""))
def nn_momentum(spark, sf_dir):
    """The predictions after two full-batch steps with momentum and a falling rate."""
    samples = _samples(spark, sf_dir)
    cfg = neural.NetConfig((64, 6, 1), hidden="scaled_tanh", output="sigmoid", rate=0.5, momentum=0.5, rate_decay=0.9)
    scored = neural.net_train(samples, cfg, batch_rows=samples.count(), epochs=2).predict(samples)
    return scored.select(F.col("id").alias("vec_id"), F.col("label")[0].alias("label"), F.round(F.col("prediction")[0], 8).alias("prediction"))


def _machine_rows(spark, machines):
    tables = [neural.weights_to_table(spark, {"W": m.W, "b": m.b[None, :], "c": m.c[None, :]}).withColumn("layer", F.lit(n)) for n, m in enumerate(machines)]
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.select("layer", "kind", "i", "j", F.round("v", 8).alias("v"))


_MACHINE_ROWS = "input as (select vec_id as id, x from v6)"
_MACHINE_TYPES = "cast(layer as int) as layer, kind, cast(i as int) as i, cast(j as int) as j, round(v, 8) as v"


@query("rbm_train", with_views("v6", f"""
    with {_MACHINE_ROWS}, {', '.join(oracle_nets.boltzmann('rbm', 'input', 64, 4, 2, 0, 0.1, 0.5))}
    select {_MACHINE_TYPES} from ({oracle_nets.listed('rbm_2', 64, 4)})"""))
def rbm_train(spark, sf_dir):
    """All weights after two steps of contrastive divergence; the draws are repeated in SQL."""
    samples = _samples(spark, sf_dir)
    return _machine_rows(spark, [neural.rbm_train(samples, hidden=4, batch_rows=samples.count(), epochs=2, momentum=0.1, alpha=0.5)])


@query("dbn_train", with_views("v6", f"""
    with {_MACHINE_ROWS}, {', '.join(oracle_nets.boltzmann('low', 'input', 64, 5, 2, 0, 0.1, 0.5))}, {oracle_nets.above('middle', 'low_2', 'input', 5)},
    {', '.join(oracle_nets.boltzmann('high', 'middle', 5, 3, 2, 1, 0.1, 0.5))}
    select {_MACHINE_TYPES} from ({oracle_nets.listed('low_2', 64, 5)} union all {oracle_nets.listed('high_2', 5, 3, 1)})"""))
def dbn_train(spark, sf_dir):
    """All weights of two stacked machines."""
    samples = _samples(spark, sf_dir)
    return _machine_rows(spark, neural.dbn_train(samples, [5, 3], batch_rows=samples.count(), epochs=2, momentum=0.1, alpha=0.5))


@query("dbn_net", "select count(*) as n, true as good from embeddings")
def dbn_net(spark, sf_dir):
    """A net that starts from stacked machines: every row is scored inside the output's range."""
    samples = _samples(spark, sf_dir)
    rows = samples.count()
    layers = neural.dbn_train(samples, [8, 4], batch_rows=rows, epochs=2, momentum=0.1, alpha=0.5)
    cfg, weights = neural.dbn_to_net(layers, outputs=1, rate=0.5, momentum=0.5)
    model = neural.net_train(samples, cfg, batch_rows=rows, epochs=2, initial=weights)
    p = F.col("prediction")[0]
    return model.predict(samples).agg(F.count(F.lit(1)).alias("n"), ((F.min(p) > 0) & (F.max(p) < 1)).alias("good"))


# ---- end-to-end jobs ------------------------------------------------------------------------------


def _job_grade(rates, bound):
    """Rows and positive rows from the confusion counts, and whether the accuracy meets the bound."""
    return rates.select((F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"), (F.col("tp") + F.col("fn")).alias("positives"), (F.col("accuracy") >= bound).alias("good"))


@query("churn_model_continuity", with_views("v1 v3", GUID_CONTINUITY + f"""
    select count(*) as n, cast(sum(case when cls <> 'a' then 1 else 0 end) as bigint) as positives, true as good
    from v3 left join by_guid g on g.guid = c_custkey where coalesce(g.continuity, 0.0) <> 0 and {_TEST}"""))
def churn_model_continuity(spark, sf_dir):
    return _job_grade(jobs.continuity_model(views.view_log(spark, sf_dir), views.base_feature_lines(spark, sf_dir)), 0.85)


@query("churn_model_titles", with_views("v1 v3", TITLE_CONTINUITY + f"""
    select count(*) as n, cast(sum(case when cls <> 'a' then 1 else 0 end) as bigint) as positives, true as good
    from v3 left join by_guid g on g.guid = c_custkey where coalesce(g.continuity, 0.0) <> 0 and {_TEST}"""))
def churn_model_titles(spark, sf_dir):
    """The continuity model with shows read from titles, and boosted trees instead of one."""
    rates = jobs.continuity_model(
        views.view_log(spark, sf_dir), views.base_feature_lines(spark, sf_dir), estimator=models.boosted_trees(rounds=5, depth=5),
        scores=lambda log: episodes.continuity_by_title(log, title="title_han"),
    )
    return _job_grade(rates, 0.85)


@query("churn_model_classic", _GRADED)
def churn_model_classic(spark, sf_dir):
    return _job_grade(jobs.classic_model(views.base_feature_lines(spark, sf_dir)), 0.5)


@query("churn_all_classifiers", with_views("v3", f"""
    select unnest(['decision_tree', 'random_forest', 'gbt', 'naive_bayes', 'svm', 'logreg']) as model, n, positives, true as good from (
        select count(*) as n, cast(sum(case when cls = 'a' then 0 else 1 end) as bigint) as positives from v3 where {_TEST})"""))
def churn_all_classifiers(spark, sf_dir):
    """All classifiers on one split: rows, churned rows (the positive class), and whether enough decisions are right.

    Token frequencies say little about the class, so naive Bayes has a lower bound; its exact scores are those of ml_naive_bayes.
    """
    rates = jobs.compare_classifiers(views.base_feature_lines(spark, sf_dir))
    return rates.select("model", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"), (F.col("tp") + F.col("fn")).alias("positives"), (F.col("accuracy") >= F.when(F.col("model") == "naive_bayes", 0.35).otherwise(0.6)).alias("good"))
