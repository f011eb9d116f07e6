"""MinHash near-dedup, components and decontamination against brute force."""

import random
import re
import time
from itertools import combinations

import numpy as np
import pytest

from stayline.llm import decontaminate, minhash, words
from stayline.llm.components import components

DOC = "doc_id long, text string, key string, component long"


def plain(rows, width, percent):
    """Component of each id by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        runs = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(runs)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def edited(draw, ws, n):
    ws = list(ws)
    for _ in range(n):
        ws[draw.randrange(len(ws))] = f"x{draw.randrange(10**6)}"
    return ws


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, width, percent):
    draw = random.Random(width)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One  two"), (5, "one"), (5, "one"), (6, "lone word here and there")]
    at = 10
    for size in (30, 80, 300):
        for _ in range(4):
            base = draw.choices(vocabulary, k=size)
            for _ in range(12):
                # a walk away from the base: links form chains, and many pairs lie just below the threshold
                base = edited(draw, base, draw.choice((0, 1, 1, 2, size // 40)))
                rows.append((at, " ".join(base)))
                at += 1
    draw.shuffle(rows)
    df = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], DOC)
    got = minhash.near_components(df, width, percent).collect()
    expected = plain(rows, width, percent)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert {r["n_shingles"] for r in got if r["doc_id"] in (0, 1, 2)} == {0}
    # the rows do hold linked groups
    assert len(set(expected.values())) < 0.7 * len(expected)


def test_one_large_group_of_near_copies(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    rows = [(i, " ".join(edited(draw, base, draw.choice((2, 4, 6, 9))))) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    got = minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == plain(rows, 3, 85)


def test_blocks_do_not_change_links(spark):
    """The residual step with tiny blocks finds the same components."""
    draw = random.Random(9)
    base = [f"w{draw.randrange(300)}" for _ in range(90)]
    rows = [(i, " ".join(edited(draw, base, draw.choice((3, 5, 8))))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bands, n = minhash.bands_for(85)
    nodes = minhash.signatures(df, 3, bands, n).selectExpr("doc_id as node", "n_shingles", "keys", "sketch").cache()
    multi = nodes.selectExpr("explode(keys) as key", "node")
    labels = nodes.selectExpr("node", "node as component")
    limit = minhash.most_differing(85, bands * n)
    for block in (4, 1000):
        left = minhash.open_rows(multi, labels, nodes, 85, limit, block)
        links = minhash.cross_links(left, labels, nodes, df, 3, 85, limit, block, stream=5)
        found = {r["node"]: r["component"] for r in components(links).collect()}
        assert {i: found.get(i, i) for i, _ in rows} == plain(rows, 3, 85)


def test_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_components(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in minhash.near_components(df).collect()) == [(0, 0, True), (0, 0, True), (1, 1, True)]


def test_estimate_is_corrected_for_chance():
    draw = np.random.default_rng(0)
    for share in (0.5, 0.85):
        errors = []
        for _ in range(60):
            both = draw.integers(0, 1 << 63, int(1000 * share), dtype=np.uint64)
            rest = draw.integers(0, 1 << 63, (2, (1000 - len(both)) // 2), dtype=np.uint64)
            a, b = (minhash.sketch(minhash.minima(np.concatenate([both, r]), 125)) for r in rest)
            x = a ^ b
            apart = int(np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum())
            errors.append(1 - apart / 125 / (1 - 0.25) - share)
        assert abs(np.mean(errors)) < 0.03
    assert (1 - 0.85**5) ** minhash.bands_for(85)[0] <= 1.1e-6


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[301] == 300 and 200 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leaks_with_substitutions_are_found(spark):
    draw = random.Random(1)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(draw.choices(vocabulary, k=n))) for i, n in enumerate((14, 30, 59, 20, 6, 1))] + [(90, None), (91, "..."), (None, "zz yy xx ww vv uu tt ss rr qq pp oo nn")]
    other = lambda n: draw.choices(vocabulary, k=n)
    put = lambda ws: " ".join(other(40) + list(ws) + other(200))
    docs, leaks = [(1, None), (2, ""), (3, put([])), (4, put(other(30)))], set()
    for i, text in items[:4]:
        ws = text.split()
        docs.append((10 + i, put(w.upper() + "," for w in ws)))
        # every sixth word is another one
        docs.append((20 + i, put(w if k % 6 != 2 else "other" for k, w in enumerate(ws))))
        leaks |= {(10 + i, i), (20 + i, i)}
    docs += [(30, items[4][1]), (31, put(items[2][1].split()[10:35])), (31, put(items[2][1].split()[10:35])), (40, items[-1][1])]
    leaks |= {(30, 4), (31, 2), (40, None)}
    leaks |= {(d, 5) for d, t in docs if t and items[5][1] in re.findall(r"\w+", t.lower())}
    frame = spark.createDataFrame([(d, t, 5) for d, t in docs], "doc_id long, text string, contamination int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks
    assert sum(r["doc_id"] == 31 and r["item_id"] == 2 for r in got) == 2
    whole = next(r for r in got if (r["doc_id"], r["item_id"]) == (11, 1))
    assert (whole["matched_words"], whole["item_words"], whole["first_word"]) == (30, 30, 40)
    # slices of the benchmark give the same rows
    parts = decontaminate.contaminated(frame, bench, slice_bytes=60).collect()
    assert sorted(map(str, parts)) == sorted(map(str, got))
    kept = decontaminate.with_hits(frame, bench)
    assert kept.columns == ["doc_id", "text", "contamination"] and kept.count() == len(docs)
    assert decontaminate.contaminated(frame.limit(0), bench).count() == 0
    assert decontaminate.contaminated(frame, bench.limit(0)).count() == 0


def test_masks_ignore_positions():
    h = words.hashes(" ".join("abcdefghijklm"))
    for mask in decontaminate.MASKS:
        other = h.copy()
        for i, c in enumerate(mask):
            if c == "0":
                other[i] += np.uint64(1)
        assert decontaminate.seeds(h, mask)[0] == decontaminate.seeds(other, mask)[0]
        assert len(decontaminate.positions(mask)) == 6


def test_every_substitution_that_the_rule_allows_is_found():
    """Items of 4 to 20 words: every set of words that may be replaced, up to a quarter of them."""
    for n in range(1, 21):
        item = [f"a{i}" for i in range(n)]
        index = decontaminate.build_index([(7, " ".join(item))])
        for k in range(n // 4 + 1):
            for gone in combinations(range(n), k):
                text = ["before"] * 3 + ["x" if i in gone else w for i, w in enumerate(item)] + ["after"] * 3
                got = decontaminate.overlaps(index, " ".join(text).encode(), 13, 0.75)
                assert [h["item_id"] for h in got] == [7], (n, gone)
                assert got[0]["overlap_words"] >= min(n, 13) and got[0]["matched_words"] >= 0.75 * got[0]["overlap_words"]


def test_masks_fit_all_runs_that_decide():
    for n in range(13, 26):
        sets = decontaminate.disagreements(n, 0.75, 13)
        assert len(sets) == 0 or np.logical_or.reduce([decontaminate.fits(m, sets, n) for m in decontaminate.MASKS]).all()
    # other rules have masks of their own
    for least, alike in ((5, 0.75), (8, 0.6), (10, 0.9), (4, 0.5)):
        masks = decontaminate.masks_for(99, least, alike)
        for n in range(least, 2 * least):
            sets = decontaminate.disagreements(n, alike, least)
            assert len(sets) == 0 or np.logical_or.reduce([decontaminate.fits(m, sets, n) for m in masks]).all()


def test_pairs_are_those_of_brute_force():
    """All alignments of random texts over few words, for items of any length and several rules."""
    draw = random.Random(9)
    for least, alike in ((13, 0.75), (6, 0.75), (13, 0.9)):
        items = [(i, [draw.choice("abcdefgh") + str(draw.randint(0, 3)) for _ in range(draw.choice((1, 3, 4, 5, 7, 9, 12, 13, 15, 21, 30)))]) for i in range(25)]
        index = decontaminate.build_index([(i, " ".join(ws)) for i, ws in items], least, alike)
        for _ in range(60):
            text = []
            while len(text) < 70:
                i, ws = draw.choice(items)
                a = draw.randint(0, len(ws) - 1)
                text += [w if draw.random() < 0.8 else "zz" for w in (ws if draw.random() < 0.5 else ws[a:])] + ["yy"] * draw.randint(0, 2)
            want = set()
            for i, ws in items:
                need = min(least, len(ws))
                for shift in range(-len(ws), len(text) + 1):
                    same = [text[shift + k] == ws[k] for k in range(len(ws)) if 0 <= shift + k < len(text)]
                    if any(sum(same[x:y]) >= alike * (y - x) - 1e-9 for x in range(len(same)) for y in range(x + need, len(same) + 1)):
                        want.add(i)
                        break
            assert {h["item_id"] for h in decontaminate.overlaps(index, " ".join(text).encode(), least, alike)} == want


def test_repeated_words_stay_cheap():
    """Items and texts of one word over and over: all alignments are hits."""
    index = decontaminate.build_index([(i, "same " * (40 + i)) for i in range(5)])
    start = time.process_time()
    got = decontaminate.overlaps(index, b"same " * 20_000, 13, 0.75)
    assert [(h["item_id"], h["matched_words"], h["first_word"]) for h in got] == [(i, 40 + i, 0) for i in range(5)]
    assert time.process_time() - start < 10


def test_overlap_is_found_if_any_run_is_one():
    draw = np.random.default_rng(5)
    for _ in range(2000):
        n, share, alike = int(draw.integers(1, 40)), draw.choice((0.3, 0.6, 0.75, 0.9)), float(draw.choice((0.6, 0.7, 0.75, 0.9, 1)))
        same, least = draw.random(n) < share, int(draw.integers(1, 14))
        fits = {(i, j) for i in range(n) for j in range(i + least, n + 1) if same[i:j].sum() >= alike * (j - i) - 1e-9}
        got = decontaminate.overlap(same, least, alike)
        assert got in fits if fits else got is None
        # the run with the highest score is the longest of those that tie
        score = lambda i, j: (3 * same[i:j].sum() - 2 * (j - i), j - i, -i)
        assert score(*decontaminate.top_run(same)) == max(score(i, j) for i in range(n + 1) for j in range(i, n + 1))


def test_each_slice_is_a_pass_of_its_own(spark, monkeypatch):
    items = [(i, " ".join(f"s{i}w{k}" for k in range(14))) for i in range(5)]
    docs = spark.createDataFrame([(1, items[3][1] + " and " + items[0][1]), (1, items[3][1]), (None, items[4][1]), (None, None), (2, "nothing")], "doc_id long, text string")
    bench, sent = spark.createDataFrame(items, "item_id long, text string"), []
    kind, real = type(spark.sparkContext), spark.sparkContext.broadcast

    def broadcast(self, value):
        if not isinstance(value, dict):
            return real(value)
        # the index before this one is gone
        assert not sent or sent[-1].gone
        made = real(value)
        destroy = made.destroy
        made.gone, made.destroy = False, lambda *a: (setattr(made, "gone", True), destroy(*a))
        sent.append(made)
        return made

    whole = decontaminate.with_hits(docs, bench).collect()
    monkeypatch.setattr(kind, "broadcast", broadcast)
    parts = decontaminate.with_hits(docs, bench, slice_bytes=80)
    assert parts.columns == ["doc_id", "text", "contamination"]
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole))
    assert len(sent) == 5 and all(b.gone for b in sent)
