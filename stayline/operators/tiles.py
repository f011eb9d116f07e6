"""Block matrices: square tiles of a fixed size as rows (ti, tj, at, values), absent tiles being zero.

``at`` has the row-major places of the cells in the tile, ``values`` their values; a tile that is full, or nearly so, has a null ``at`` and
all its cells in order. So a matrix takes the room of its cells, however thin they are spread over tiles.

A product deals both factors to a grid: the left one is copied along the grid's columns, the right one along its rows, so that even a
single inner tile index spreads over all tasks. Cells are multiplied where they meet, full tiles by dense products. Partial tiles are
added in levels (``_total``).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.matrix import coo_build
from stayline.session import cut_lineage

# tasks get these functions with their closure, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = "ti long, tj long, at array<int>, values array<double>"
_TILE = pa.schema([("ti", pa.int64()), ("tj", pa.int64()), ("at", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
_COLUMNS = ["ti", "tj", "at", "values"]
SIZE = 64
# cells that are taken up at once, and products that are held at once
CELLS = 1 << 17
PRODUCTS = 1 << 20


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles in slices of about ``CELLS`` cells, one tile at least."""
    for batch in batches:
        ends = np.cumsum(batch.column("values").value_lengths().to_numpy())
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CELLS, "right")))
            yield batch.slice(low, high - low)
            low = high


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells per tile, and place and value of each cell."""
    at, values = batch.column("at"), batch.column("values")
    counts, v = values.value_lengths().to_numpy().astype(np.int64), values.flatten().to_numpy()
    place = np.arange(len(v)) - np.repeat(np.cumsum(counts) - counts, counts)
    given = np.repeat(at.is_valid().to_numpy(zero_copy_only=False), counts)
    place[given] = at.flatten().to_numpy()
    return counts, place, v


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat, kind))


def _tiles(ti: np.ndarray, tj: np.ndarray, counts: np.ndarray, at: np.ndarray, v: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Rows for tiles whose cells follow each other; tiles of two thirds or more of their cells are written in full."""
    full = 3 * counts >= 2 * size * size
    if full.any():
        own = np.repeat(full, counts)
        values = np.zeros(int(full.sum()) * size * size)
        values[np.repeat(np.arange(int(full.sum())), counts[full]) * size * size + at[own]] = v[own]
        whole = [pa.array(ti[full]), pa.array(tj[full]), pa.nulls(int(full.sum()), _TILE.field("at").type), _lists(values, np.full(int(full.sum()), size * size), pa.float64())]
        yield pa.RecordBatch.from_arrays(whole, schema=_TILE)
        ti, tj, counts, at, v = ti[~full], tj[~full], counts[~full], at[~own], v[~own]
    if len(ti):
        thin = [pa.array(ti), pa.array(tj), _lists(at, counts, pa.int32()), _lists(v, counts, pa.float64())]
        yield pa.RecordBatch.from_arrays(thin, schema=_TILE)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]) if len(keys[0]) else np.zeros(0, np.int64)


def _summed(number: np.ndarray, at: np.ndarray, v: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells in order of (tile number, place), those at the same place added."""
    key = number * size * size + at
    n = int(number.max(initial=-1) + 1) * size * size
    if n <= 8 * len(key):  # without sorting
        there, total = np.flatnonzero(np.bincount(key, minlength=n)), np.bincount(key, v, n)
        return there // (size * size), there % (size * size), total[there]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = _starts(key)
    return key[first] // (size * size), key[first] % (size * size), np.add.reduceat(v[order], first)


def tile(entries: DataFrame, size: int = SIZE) -> DataFrame:
    """COO triples (i, j, v) to tiles; repeated cells are summed first, so a tile gathers at most size² cells."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            ti, tj, at, v = (np.concatenate([rest[n], c.to_numpy()]) if rest else c.to_numpy() for n, c in enumerate(batch.columns))
            if not len(ti):
                continue
            starts = _starts(ti, tj)
            end = starts[-1]  # the last tile may go on
            rest = [c[end:] for c in (ti, tj, at, v)]
            if end:
                yield from _tiles(ti[starts[:-1]], tj[starts[:-1]], np.diff(starts), at[:end], v[:end], size)
        if rest:
            yield from _tiles(rest[0][:1], rest[1][:1], np.array([len(rest[0])]), rest[2], rest[3], size)

    cells = coo_build(entries).select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))
    within = F.pmod("i", F.lit(size)) * size + F.pmod("j", F.lit(size))
    placed = cells.select(F.floor(F.col("i") / size).alias("ti"), F.floor(F.col("j") / size).alias("tj"), within.cast("int").alias("at"), "v")
    return placed.repartition("ti", "tj").sortWithinPartitions("ti", "tj", "at").mapInArrow(pack, TILE)


def untile(tiles: DataFrame, size: int = SIZE) -> DataFrame:
    """Tiles to the COO triples of their cells that aren't zero."""
    at = F.coalesce("at", F.sequence(F.lit(0), F.lit(size * size - 1)))
    cell = tiles.select("ti", "tj", F.inline(F.arrays_zip(at.alias("at"), F.col("values").alias("v")))).where(F.col("v") != 0)
    return cell.select(
        (F.col("ti") * size + F.floor(F.col("at") / size)).alias("i"), (F.col("tj") * size + F.col("at") % size).alias("j"), "v"
    )


def transpose(tiles: DataFrame, size: int = SIZE) -> DataFrame:
    turned = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.get("values", (k % size) * size + F.floor(k / size).cast("int")))
    at = F.transform("at", lambda k: (k % size) * size + F.floor(k / size).cast("int"))
    values = F.when(F.col("at").isNull(), turned).otherwise(F.col("values"))
    return tiles.select(F.col("tj").alias("ti"), F.col("ti").alias("tj"), at.alias("at"), values.alias("values"))


def moved(tiles: DataFrame, rows: int, cols: int, size: int = SIZE) -> DataFrame:
    """Tiles of the matrix moved down and right; a tile that then lies across borders becomes up to four partial ones."""
    (down, r), (right, c) = divmod(rows, size), divmod(cols, size)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            ti, tj = (part.column(k).to_numpy() for k in (0, 1))
            counts, at, v = _cells(part)
            (a, i), (b, j) = np.divmod(at // size + r, size), np.divmod(at % size + c, size)
            piece = np.repeat(np.arange(len(ti)), counts) * 4 + a * 2 + b
            piece, at, v = _summed(piece, i * size + j, v, size)
            starts = _starts(piece)
            own = piece[starts]
            yield from _tiles(ti[own // 4] + down + own % 4 // 2, tj[own // 4] + right + own % 2, np.diff(np.r_[starts, len(piece)]), at, v, size)

    if not r and not c:
        return tiles.select((F.col("ti") + down).alias("ti"), (F.col("tj") + right).alias("tj"), "at", "values")
    return tiles.select(*_COLUMNS).mapInArrow(move, TILE)


def _runs(tiles: DataFrame, size: int) -> DataFrame:
    """One row for each run of equal tiles inside a partition; only the present sums are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for part in _slices(batches):
            ti, tj = (part.column(k).to_numpy() for k in (0, 1))
            counts, at, v = _cells(part)
            if rest:
                ti, tj, counts = np.r_[rest[0], ti], np.r_[rest[1], tj], np.r_[len(rest[2]), counts]
                at, v = np.r_[rest[2], at], np.r_[rest[3], v]
            starts = _starts(ti, tj)
            number = np.zeros(len(ti), np.int64)
            number[starts[1:]] = 1
            number, at, v = _summed(np.repeat(np.cumsum(number), counts), at, v, size)
            ti, tj, counts = ti[starts], tj[starts], np.bincount(number, minlength=len(starts))
            end = len(v) - counts[-1]
            rest = (ti[-1:], tj[-1:], at[end:], v[end:])
            if len(ti) > 1:
                yield from _tiles(ti[:-1], tj[:-1], counts[:-1], at[:end], v[:end], size)
        if rest:
            yield from _tiles(rest[0], rest[1], np.array([len(rest[2])]), rest[2], rest[3], size)

    return tiles.select(*_COLUMNS).mapInArrow(run, TILE)


def _total(tiles: DataFrame, size: int) -> DataFrame:
    """Equal tiles added: by groups of tasks, then all. However many tasks share a tile, no task reads more than about √tasks of each."""
    fan = math.ceil(math.sqrt(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    group = tiles.withColumn("_group", F.spark_partition_id() % fan)
    middle = _runs(group.repartition("ti", "tj", "_group").sortWithinPartitions("ti", "tj"), size)
    return _runs(middle.repartition("ti", "tj").sortWithinPartitions("ti", "tj"), size)


def add(*parts: DataFrame, size: int = SIZE) -> DataFrame:
    """The sum of matrices tiled alike."""
    total = parts[0].select(*_COLUMNS)
    for part in parts[1:]:
        total = total.unionByName(part.select(*_COLUMNS))
    return _total(total, size)


def hconcat(left: DataFrame, right: DataFrame, left_cols: int, size: int = SIZE) -> DataFrame:
    return add(left, moved(right, 0, left_cols, size), size=size)


def vconcat(top: DataFrame, bottom: DataFrame, top_rows: int, size: int = SIZE) -> DataFrame:
    return add(top, moved(bottom, top_rows, 0, size), size=size)


HELD = 256


def _ends(a: DataFrame, b: DataFrame) -> dict[str, int]:
    """Inner tile indices, tile rows, tile columns (about), and cells of both factors."""
    none = F.lit(None).cast("long")
    ends = a.select(F.col("tj").alias("k"), F.col("ti").alias("r"), none.alias("c"), F.size("values").alias("x"), F.lit(0).alias("y")).unionByName(
        b.select(F.col("ti").alias("k"), none.alias("r"), F.col("tj").alias("c"), F.lit(0).alias("x"), F.size("values").alias("y"))
    )
    n = ends.agg(*[F.approx_count_distinct(c).alias(c) for c in "krc"], *[F.sum(c).alias(c) for c in "xy"]).first()
    return {k: max(n[k] or 0, 1) for k in "krcxy"}


def _grid(a: DataFrame, b: DataFrame) -> int:
    """Copies along each side: so many that few inner tile indices still spread over all tasks, and that the result tiles of a grid
    cell fit a task's sums, but √tasks at most."""
    return _side(_ends(a, b), int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _side(n: dict[str, int], tasks: int) -> int:
    spread = math.ceil(math.sqrt(tasks / min(n["k"], tasks)))
    return max(spread, min(math.ceil(math.sqrt(n["r"] * n["c"] / HELD)), math.ceil(math.sqrt(tasks))))


def _sides(n: dict[str, int], tasks: int, size: int) -> tuple[int, int]:
    """Rows and columns of the grid: as many cells as a square one of ``_side`` or up to one per task, so that copies of the factors
    and partial sums together are few."""
    least = min(_side(n, tasks) ** 2, n["r"] * n["c"])
    products = n["x"] * n["y"] / (n["k"] * size)
    steps = sorted({math.ceil(1.25**e) for e in range(60)})

    def moved_cells(grid: tuple[int, int]) -> float:
        rows, cols = grid
        return n["x"] * cols + n["y"] * rows + max(1, tasks / (rows * cols)) * min(n["r"] * n["c"] * size * size, products)

    fitting = {(rows, max(cols, -(-least // rows))) for rows in steps for cols in steps if rows <= n["r"] and cols <= n["c"] and rows * cols <= max(tasks, least)}
    return min(sorted(g for g in fitting if g[1] <= n["c"]) or [(n["r"], n["c"])], key=moved_cells)


# so many cell products of a tile pair, as a share of size³, make its dense product cheaper
DENSE = 1 / 64


def multiply(a: DataFrame, b: DataFrame, size: int = SIZE, grid: int | None = None, upper: bool = False, held: int = HELD) -> DataFrame:
    """a·b; ``upper`` gives only the tiles on and above the diagonal.

    Both factors are written once and dealt by grid cell and inner tile index. A task walks through a cell's inner indices in order; it
    holds the left cells of one of them and at most ``held`` tiles of sums. Sums that don't fit go out as they are, by their cells only.
    No pair of tiles is ever written out.
    """
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = cut_lineage(a.select(*_COLUMNS)), cut_lineage(b.select(*_COLUMNS))
    n = _ends(a, b)
    return _product(a, b, size, (grid, grid) if grid else _sides(n, tasks, size), upper, held)


def _product(a: DataFrame, b: DataFrame, size: int, sides: tuple[int, int], upper: bool, held: int) -> DataFrame:
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_rows, n_cols = sides
    buckets = -(-tasks // (n_rows * n_cols))  # partitions of a grid cell, each with some inner indices
    across, down = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (n_cols, n_rows))
    left = a.select((F.pmod("ti", F.lit(n_rows))).alias("row"), across.alias("col"), F.col("tj").alias("k"), F.lit(0).alias("side"), F.col("ti").alias("t"), "at", "values")
    right = b.select(down.alias("row"), F.pmod("tj", F.lit(n_cols)).alias("col"), F.col("ti").alias("k"), F.lit(1).alias("side"), F.col("tj").alias("t"), "at", "values")
    both = left.unionByName(right)
    place = (F.col("row") * n_cols + F.col("col")) * buckets + F.pmod(F.xxhash64("k"), F.lit(buckets))
    dealt = both.repartitionById(n_rows * n_cols * buckets, place.cast("int")).sortWithinPartitions("row", "col", "k", "side", "t")
    area = size * size

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, slots = np.zeros(held * area), {}

        def flush() -> Iterator[pa.RecordBatch]:
            at = list(slots)
            slots.clear()
            for low in range(0, len(at), 32):
                part = sums[low * area : min(low + 32, len(at)) * area]
                there = np.flatnonzero(part)
                counts = np.bincount(there // area, minlength=len(part) // area)
                some = np.flatnonzero(counts)
                own = np.array(at[low : low + 32], np.int64)[some]
                yield from _tiles(own[:, 0], own[:, 1], counts[some], there % area, part[there], size)
                part[:] = 0

        def room(pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            """Slots for these tiles, at most ``held`` of them."""
            if sum(p not in slots for p in pairs) + len(slots) > held:
                yield from flush()
            for p in pairs:
                slots.setdefault(p, len(slots))

        last, kept = None, None  # the group of the last row, and its left cells so far
        for part in _slices(batches):
            row, col, k, side, t = (c.to_numpy() for c in part.columns[:5])
            counts, at, v = _cells(part)
            starts = np.zeros(len(row), np.int64)
            starts[_starts(row, col, k)[1:]] = 1
            group = np.cumsum(starts)
            if (row[0], col[0], k[0]) != last:
                kept = None
            if last and (row[0], col[0]) != last[:2]:
                yield from flush()
            last = (row[-1], col[-1], k[-1])
            cells = [np.repeat(group, counts), np.repeat(t, counts), at, v]
            is_left, there = np.repeat(side == 0, counts), v != 0  # a zero in a full tile is no cell
            lg, lt, la, lv = (c[is_left & there] for c in cells)
            if kept:
                lg, lt, la, lv = np.r_[np.zeros(len(kept[0]), np.int64), lg], np.r_[kept[0], lt], np.r_[kept[1], la], np.r_[kept[2], lv]
            goes_on = lg == group[-1]
            kept = (lt[goes_on], la[goes_on], lv[goes_on])
            rg, rt, ra, rv = (c[~is_left & there] for c in cells)
            if not len(lg) or not len(rg):
                continue

            # tiles by number instead of name, and how many pairs of them a group has
            n = int(group[-1]) + 1
            in_l, in_r = _starts(lg, lt), _starts(rg, rt)
            pairs = np.bincount(lg[in_l], minlength=n) * np.bincount(rg[in_r], minlength=n)
            (names_l, of_l), (names_r, of_r) = (np.unique(x, return_inverse=True) for x in (lt[in_l], rt[in_r]))
            lt, rt = np.repeat(of_l, np.diff(np.r_[in_l, len(lt)])), np.repeat(of_r, np.diff(np.r_[in_r, len(rt)]))

            # cells meet by group and inner index
            order = np.argsort(rg * size + ra // size, kind="stable")
            rg, rt, ra, rv = rg[order], rt[order], ra[order], rv[order]
            met = np.bincount(rg * size + ra // size, minlength=n * size)
            inner = lg * size + la % size
            meets, first = met[inner], (np.cumsum(met) - met)[inner]
            dense = np.bincount(lg, meets, n) > pairs * size**3 * DENSE
            if dense.any() and not (np.isfinite(lv).all() and np.isfinite(rv).all()):
                dense[:] = False  # cells that aren't there would take part
            for g in np.flatnonzero(dense & (pairs > 0)):
                x, y = [], []
                for out, own, names, tt, aa, vv in ((x, lg == g, names_l, lt, la, lv), (y, rg == g, names_r, rt, ra, rv)):
                    some, number = np.unique(tt[own], return_inverse=True)
                    whole = np.bincount(number * area + aa[own], vv[own], len(some) * area)
                    out += zip(names[some].tolist(), whole.reshape(-1, size, size))
                for ti, one in x:
                    for tj, two in y:
                        if not upper or ti <= tj:
                            yield from room([(ti, tj)])
                            s = slots[ti, tj]
                            sums[s * area : (s + 1) * area] += (one @ two).ravel()

            use = np.flatnonzero((meets > 0) & ~dense[lg])
            if not len(use):
                continue
            lt, la, lv, meets, first = (c[use] for c in (lt, la, lv, meets, first))
            li, rj = la // size * size, ra % size
            ends = np.cumsum(meets)
            low = 0
            while low < len(meets):
                base = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, base + PRODUCTS, "right")))
                m = meets[low:high]
                x = np.repeat(np.arange(low, high), m)
                y = np.arange(len(x)) + np.repeat(first[low:high] - (ends[low:high] - m - base), m)
                low = high
                if upper:
                    fits = names_l[lt[x]] <= names_r[rt[y]]
                    x, y = x[fits], y[fits]
                pair, place, value = lt[x] * len(names_r) + rt[y], li[x] + rj[y], lv[x] * rv[y]
                if not len(pair):
                    continue
                slot = None
                if len(names_l) * len(names_r) <= PRODUCTS:
                    seen = np.zeros(len(names_l) * len(names_r), bool)
                    seen[pair] = True
                    found = np.flatnonzero(seen)
                    if len(found) <= held:
                        named = list(zip(names_l[found // len(names_r)].tolist(), names_r[found % len(names_r)].tolist()))
                        yield from room(named)
                        slot = np.zeros(len(seen), np.int64)
                        slot[found] = [slots[p] for p in named]
                        np.add.at(sums, slot[pair] * area + place, value)
                if slot is None:  # too many tiles for the sums
                    pair, place, value = _summed(pair, place, value, size)
                    begin = _starts(pair)
                    own = pair[begin]
                    yield from _tiles(names_l[own // len(names_r)], names_r[own % len(names_r)], np.diff(np.r_[begin, len(pair)]), place, value, size)
        yield from flush()

    return _total(dealt.mapInArrow(products, TILE), size)


def row_tiles(rows: DataFrame, cells: str, size: int = SIZE) -> DataFrame:
    """Rows with sparse cells (array of structs ``j, v``) to tiles: any ``size`` rows of a task share a tile row of a number of its own.

    For products that sum over rows, where it doesn't matter which rows share a tile. Repeated cells of a row add up.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            ends = np.cumsum(batch.column(0).value_lengths().fill_null(0).to_numpy())
            low = 0
            while low < batch.num_rows:  # a whole number of tile rows at a time
                high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CELLS, "right"))
                high = low + max(size, (high - low) // size * size)
                part = batch.column(0).slice(low, high - low)
                counts = part.value_lengths().fill_null(0).to_numpy()
                flat = part.flatten()
                j, v = flat.field("j").to_numpy(zero_copy_only=False).astype(np.int64), flat.field("v").to_numpy(zero_copy_only=False).astype(float)
                i = np.repeat(np.arange(len(counts)), counts)
                names, tj = np.unique(j // size, return_inverse=True)
                if len(names):
                    number, at, v = _summed(i // size * len(names) + tj, i % size * size + j % size, v, size)
                    starts = _starts(number)
                    own = number[starts]
                    yield from _tiles(nth + own // len(names), names[own % len(names)], np.diff(np.r_[starts, len(number)]), at, v, size)
                nth += -(-len(counts) // size)
                low = high

    found = rows.select(F.col(cells).cast("array<struct<j: long, v: double>>").alias("cells")).mapInArrow(cut, TILE)
    number = F.col("ti") + F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return found.select(number.alias("ti"), "tj", "at", "values")


def gram_wide(rows: DataFrame, cells: str, size: int = SIZE) -> DataFrame:
    """Tiles on and above the diagonal of XᵀX for rows of sparse cells: pairs of column ranges, so no task holds width²."""
    x = cut_lineage(row_tiles(rows, cells, size))
    turned = transpose(x, size)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _product(turned, x, size, _sides(_ends(turned, x), tasks, size), True, HELD)
