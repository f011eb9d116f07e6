"""SQL text that repeats training steps of the networks: their draws, and two-layer nets and Boltzmann machines step by step."""

from __future__ import annotations

MASK = (1 << 64) - 1
GOLDEN = 0x9E3779B97F4A7C15


def _mul(x: str, c: int) -> str:
    return f"(({x})::uhugeint * {c}::uhugeint & {MASK}::uhugeint)::ubigint"


def _add(x: str, y: str) -> str:
    return f"(({x})::uhugeint + ({y})::uhugeint & {MASK}::uhugeint)::ubigint"


def _mixed(values: str) -> str:
    """The finaliser of the draws, for each number of a list."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = f"list_transform({values}, lambda z: {_mul(f'xor(z, z >> {shift})', factor)})"
    return f"list_transform({values}, lambda z: xor(z, z >> 31))"


def state(key: str, *salts: int) -> str:
    """A list of one number: what a row's draws start from."""
    now = _mixed(f"[({key})::ubigint]")
    for s in salts:
        now = _mixed(f"list_transform({now}, lambda z: {_add('z', str((s * GOLDEN + 1) & MASK))})")
    return now


def uniforms(start: str, width: int) -> str:
    """``width`` numbers in [0, 1) from a column that holds a ``state``."""
    grid = f"list_transform(range(1, {width + 1}), lambda j: {_add(f'{start}[1]', _mul('j', GOLDEN))})"
    return f"list_transform({_mixed(grid)}, lambda z: (z >> 11)::double / {1 << 53}.0)"


def sigmoid(z: str) -> str:
    return f"(1 / (1 + exp(-({z}))))"


def matrix(name: str, cells: str) -> str:
    """A one-row CTE ``m``: list of rows, from rows (i, j, v)."""
    return f"{name} as materialized (select list(r order by i) as m from (select i, list(v order by j) as r from ({cells}) group by i))"


def boltzmann(name: str, rows: str, width: int, hidden: int, steps: int, depth: int, momentum: float, alpha: float, seed: int = 1) -> list[str]:
    """CTEs of full-batch steps of one machine over ``rows`` (id, x); the last are ``{name}_{steps}`` with W, b, c of one row."""
    zeros = lambda n: f"list_transform(range({n}), lambda i: 0.0::double)"
    grid = f"list_transform(range({hidden}), lambda i: {zeros(width)})"
    out = [f"{name}_0 as (select {grid} as w, {zeros(width)} as b, {zeros(hidden)} as c, {grid} as vw, {zeros(width)} as vb, {zeros(hidden)} as vc)"]
    for n in range(steps):
        p, q = f"{name}_{n}", f"{name}_{n}"
        hid = lambda v: f"list_transform(range(1, {hidden + 1}), lambda k: {sigmoid(f'list_inner_product({v}, w[k]) + c[k]')})"
        vis = f"list_transform(range(1, {width + 1}), lambda j: {sigmoid('list_inner_product(h1, list_transform(w, lambda r: r[j])) + b[j]')})"
        drawn = lambda prob, u, size: f"list_transform(range(1, {size + 1}), lambda i: case when {prob}[i] > {u}[i] then 1.0::double else 0.0::double end)"
        out += [
            f"{q}s as materialized (select id, x, {state('id', seed, n, depth, 1)} as s1, {state('id', seed, n, depth, 2)} as s2 from {rows})",
            f"{q}u as materialized (select id, x, {uniforms('s1', hidden)} as u1, {uniforms('s2', width)} as u2 from {q}s)",
            f"{q}p as materialized (select id, x, u1, u2, {hid('x')} as ph from {q}u, {p})",
            f"{q}h as materialized (select id, x, u2, {drawn('ph', 'u1', hidden)} as h1 from {q}p)",
            f"{q}q as materialized (select id, x, u2, h1, {vis} as pv from {q}h, {p})",
            f"{q}v as materialized (select id, x, h1, {drawn('pv', 'u2', width)} as v2 from {q}q)",
            f"{q}e as materialized (select id, x, h1, v2, {hid('v2')} as h2 from {q}v, {p})",
            f"{q}w as (select k, list(v order by j) as g from (select k, j, avg(h1[k] * x[j] - h2[k] * v2[j]) as v from {q}e, range(1, {hidden + 1}) a(k), range(1, {width + 1}) d(j) group by k, j) group by k)",
            f"{q}b as (select list(v order by j) as g from (select j, avg(x[j] - v2[j]) as v from {q}e, range(1, {width + 1}) d(j) group by j))",
            f"{q}c as (select list(v order by k) as g from (select k, avg(h1[k] - h2[k]) as v from {q}e, range(1, {hidden + 1}) a(k) group by k))",
            f"{q}g as materialized (select (select list(g order by k) from {q}w) as gw, (select g from {q}b) as gb, (select g from {q}c) as gc)",
            f"""{q}m as materialized (select w, b, c,
                list_transform(range(1, {hidden + 1}), lambda k: list_transform(range(1, {width + 1}), lambda j: {momentum} * vw[k][j] + {alpha} * gw[k][j])) as vw,
                list_transform(range(1, {width + 1}), lambda j: {momentum} * vb[j] + {alpha} * gb[j]) as vb,
                list_transform(range(1, {hidden + 1}), lambda k: {momentum} * vc[k] + {alpha} * gc[k]) as vc from {p}, {q}g)""",
            f"""{name}_{n + 1} as materialized (select list_transform(range(1, {hidden + 1}), lambda k: list_transform(range(1, {width + 1}), lambda j: w[k][j] + vw[k][j])) as w,
                list_transform(range(1, {width + 1}), lambda j: b[j] + vb[j]) as b, list_transform(range(1, {hidden + 1}), lambda k: c[k] + vc[k]) as c, vw, vb, vc from {q}m)""",
        ]
    return out


def above(name: str, machine: str, rows: str, hidden: int) -> str:
    """Rows (id, x) of hidden probabilities over a trained machine."""
    return f"{name} as materialized (select id, list_transform(range(1, {hidden + 1}), lambda k: {sigmoid('list_inner_product(x, w[k]) + c[k]')}) as x from {rows}, {machine})"


def listed(machine: str, width: int, hidden: int, layer: int = 0) -> str:
    """All weights of a machine as rows ``layer, kind, i, j, v``."""
    return f"""select {layer} as layer, 'W' as kind, k - 1 as i, j - 1 as j, w[k][j] as v from {machine}, range(1, {hidden + 1}) a(k), range(1, {width + 1}) d(j)
        union all select {layer}, 'b', 0, j - 1, b[j] from {machine}, range(1, {width + 1}) d(j) union all select {layer}, 'c', 0, k - 1, c[k] from {machine}, range(1, {hidden + 1}) a(k)"""


def first_weights(name: str, inputs: int, units: int, layer: int, seed: int = 1) -> list[str]:
    """Start weights of one layer: a one-row CTE ``m``."""
    return [
        f"{name}s as materialized (select i, {state('i', seed, 1000 + layer)} as s from range({units}) t(i))",
        f"{name} as materialized (select list(list_transform({uniforms('s', inputs + 1)}, lambda u: (u - 0.5) * 8.0 * sqrt(6.0 / {inputs + units}.0)) order by i) as m from {name}s)",
    ]


def two_layers(rows: str, width: int, hidden: int, epochs: int, rate: float, momentum: float = 0.0, decay: float = 1.0, act: str = "sigmoid", seed: int = 1) -> list[str]:
    """CTEs of full-batch steps of a net with one hidden layer and one sigmoid output over ``rows`` (id, x with 1 ahead, y).

    ``n{i}`` are the weights (w0, w1) after i steps; ``o{i}`` the rows with their output there.
    """
    if act == "sigmoid":
        f, slope = sigmoid, "a[k + 1] * (1 - a[k + 1])"
    else:
        f, slope = (lambda z: f"1.7159 * tanh(({z}) * (2.0 / 3.0))"), "1.7159 * (2.0 / 3.0) * (1 - pow(a[k + 1] / 1.7159, 2))"
    zero = lambda n: f"list_transform(range({n}), lambda j: 0.0::double)"
    out = [*first_weights("init0", width, hidden, 0, seed), *first_weights("init1", hidden, 1, 1, seed)]
    out.append(f"n0 as (select (select m from init0) as w0, (select m[1] from init1) as w1, list_transform(range({hidden}), lambda k: {zero(width + 1)}) as v0, {zero(hidden + 1)} as v1)")
    for i in range(epochs + 1):
        out += [
            f"a{i} as materialized (select id, x, y, list_prepend(1.0::double, list_transform(range(1, {hidden + 1}), lambda k: {f('list_inner_product(x, w0[k])')})) as a from {rows}, n{i})",
            f"o{i} as materialized (select id, x, y, a, {sigmoid('list_inner_product(a, w1)')} as o from a{i}, n{i})",
        ]
        if i == epochs:
            break
        move = rate * decay**i
        out += [
            f"d{i} as materialized (select x, a, -(y - o) * o * (1 - o) as d from o{i})",
            f"e{i} as materialized (select x, a, d, list_transform(range(1, {hidden + 1}), lambda k: d * w1[k + 1] * ({slope})) as e from d{i}, n{i})",
            f"g{i} as materialized (select list(g order by k) as g0, (select list(v order by j) from (select j, avg(d * a[j]) as v from e{i}, range(1, {hidden + 2}) q(j) group by j)) as g1 from "
            f"(select k, list(v order by j) as g from (select k, j, avg(e[k] * x[j]) as v from e{i}, range(1, {hidden + 1}) p(k), range(1, {width + 2}) q(j) group by k, j) group by k))",
            f"m{i} as materialized (select w0, w1, list_transform(range(1, {hidden + 1}), lambda k: list_transform(range(1, {width + 2}), lambda j: {move} * g0[k][j] + {momentum} * v0[k][j])) as v0, "
            f"list_transform(range(1, {hidden + 2}), lambda j: {move} * g1[j] + {momentum} * v1[j]) as v1 from n{i}, g{i})",
            f"n{i + 1} as materialized (select list_transform(range(1, {hidden + 1}), lambda k: list_transform(range(1, {width + 2}), lambda j: w0[k][j] - v0[k][j])) as w0, "
            f"list_transform(range(1, {hidden + 2}), lambda j: w1[j] - v1[j]) as w1, v0, v1 from m{i})",
        ]
    return out
