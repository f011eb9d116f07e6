"""Ball k-means and product codes against plain Lloyd rounds."""

import hashlib
import math
import random

import numpy as np
import pytest

from stayline.llm import vector_codes
from stayline.llm.queries import QUERIES


def plain(rows, parts, entries, rounds, scale=4096):
    """Rows (id, vector, label) to (id, code, error, label error) and the codebooks, by comparing every part with every entry."""
    kept = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == width * parts]
    x = np.array([r[1] for r in kept]).reshape(len(kept), parts, width)
    books = x[:entries].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        codes = far.argmin(axis=2)
        if step < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    own = x[codes[:, p] == e, p]
                    if len(own):
                        books[p, e] = own.sum(axis=0) // len(own)
    errors = far.min(axis=2).sum(axis=1).tolist()
    total = {}
    for r, e in zip(kept, errors):
        total[r[2]] = total.get(r[2], 0) + e
    out = [(r[0], "".join(f"{c:02x}" for c in cs), e, total[r[2]]) for r, cs, e in zip(kept, codes.tolist(), errors)]
    return sorted(out, key=repr), ",".join(map(str, books.ravel().tolist()))


def vectors(n, width, seed=3, spread=1.0):
    draw = random.Random(seed)
    return [(i, [round(draw.gauss((i % 5) * spread, 0.4), 3) for _ in range(width)], i % 3 if i % 7 else None) for i in range(n)]


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("n,parts,entries,rounds,block", [(300, 4, 8, 5, 32), (300, 2, 40, 4, 1000), (5, 2, 16, 3, 2), (200, 8, 16, 0, 64), (120, 1, 1, 2, 16)])
def test_against_plain_rounds(spark, n, parts, entries, rounds, block):
    rows = vectors(n, 8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    coded, books = vector_codes.compress(df, parts, entries, rounds, block=block, buckets=3)
    want, listing = plain(rows, parts, entries, rounds)
    got = vector_codes.digest(coded, books).collect()
    assert sorted([tuple(r)[:4] for r in got], key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(listing.encode()).hexdigest()}


def test_odd_rows(spark):
    rows = vectors(60, 8) + [(i, [0.5] * 8, 1) for i in range(40, 80)] + [(7, [0.1] * 8, 2), (None, [0.3] * 8, None), (None, [0.3] * 8, None)]
    bad = [(-9, None, 1), (-8, [None] + [0.0] * 7, 1), (-7, [math.nan] * 8, 1), (-6, [math.inf] + [0.0] * 7, None), (-5, [-math.inf] * 8, 1)]
    df = spark.createDataFrame([(1, *r, "x") for r in rows + bad], "code int, vec_id long, embedding array<double>, label int, block string")
    coded, books = vector_codes.compress(df, 4, 16, 6, block=16, buckets=2)
    want, listing = plain(rows, 4, 16, 6)
    assert sorted([tuple(r)[:4] for r in vector_codes.digest(coded, books).collect()], key=repr) == want and vector_codes.listing(books) == listing
    # another length has no code; huge components are held to the limit
    other = spark.createDataFrame(rows[:20] + [(900, [1.0] * 4, 1), (901, [1e30, -1e30] * 4, 1)], SCHEMA)
    coded, _ = vector_codes.compress(other, 4, 4, 2, block=16)
    got = {r["vec_id"]: r for r in coded.collect()}
    assert len(got) == 22 and got[900]["code"] is None and got[900]["error"] is None and got[901]["error"] >= 0
    with pytest.raises(ValueError):
        vector_codes.compress(other, 3)
    for empty in ([], bad):
        coded, books = vector_codes.compress(spark.createDataFrame(empty, SCHEMA))
        assert vector_codes.digest(coded, books).collect() == [] and books.size == 0


def test_balls_are_exact_and_spare_work():
    draw = np.random.default_rng(5)
    centres = draw.integers(-4000, 4000, (24, 6))
    x = centres[draw.integers(0, 24, 3000)] + draw.integers(-60, 60, (3000, 6))
    far = lambda c: ((x[:, None] - c[None]) ** 2).sum(axis=2)
    books = centres + draw.integers(-40, 40, centres.shape)
    books[3] = books[9]  # equal entries: the lower index wins
    codes, radii, work = vector_codes.reassign(x, np.zeros(3000, int), None, None, books)
    assert (codes == far(books).argmin(axis=1)).all()
    # nothing moved, nothing is measured
    again, same, work = vector_codes.reassign(x, codes, radii, books, books)
    assert work == 0 and (again == codes).all() and (same[same >= 0] <= radii[same >= 0]).all()
    # entries that move a little: near one distance a part instead of 24
    new = books + draw.integers(-3, 4, books.shape)
    after, bound, work = vector_codes.reassign(x, codes, radii, books, new)
    assert (after == far(new).argmin(axis=1)).all() and work < 3 * len(x)
    for j in range(24):
        own = after == j
        assert not own.any() or bound[j] >= far(new)[own, j].max()
    # whole numbers on a small grid: many ties
    x = draw.integers(0, 4, (2000, 2))
    for seed in range(20):
        entries = np.random.default_rng(seed).integers(0, 4, (9, 2))
        start = np.random.default_rng(seed + 1).integers(0, 9, 2000)
        codes, radii, _ = vector_codes.reassign(x, start, None, None, entries)
        assert (codes == ((x[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
        moved = np.where(np.random.default_rng(seed).random((9, 1)) < 0.3, entries + 1, entries)
        after, _, _ = vector_codes.reassign(x, codes, radii, entries, moved)
        assert (after == ((x[:, None] - moved[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, listing = plain(rows, 8, 16, 6)
    got = QUERIES["op13_vector_codes"](spark, sf).collect()
    assert sorted([tuple(r)[:4] for r in got], key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(listing.encode()).hexdigest()}
