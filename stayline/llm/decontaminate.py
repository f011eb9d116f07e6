"""Benchmark decontamination by spaced-seed hashing.

A mask looks at some positions of a run of words and ignores the others, so a hash under it survives substitutions at the
ignored positions. The windows of test items are hashed under all masks and kept as a sorted index; the windows of each
document are hashed the same way and joined to the index inside the task that reads the document. Every hit fixes how item and
document line up, and around it the aligned words are compared. A document is contaminated by an item if any run of them has
``least`` words (or the whole of a shorter item) of which ``alike`` agree. The overlap is the best-scoring run (a match counts 1,
a mismatch -2) or, where that run is too short or agrees too little, the run that exceeds ``alike`` by most words.

No overlap is lost: every way in which the words of a run may disagree leaves room for one of the masks. A run of 26 words or
more holds a shorter one that agrees enough, so runs of 13 to 25 words decide, and ``MASKS`` fit all of them. Items of fewer words
must be met whole and have masks of their own length, found by ``covering``; so have rules looser than three quarters of 13 words.

The index is sent to the tasks in slices of at most ``slice_bytes`` of item text (or one longer item). A benchmark of one slice
is one pass, in which documents are neither shuffled nor gathered. With more slices the documents are written once with a row
number, each slice is a job of its own that writes its hits and then drops its index, and the hits are joined to the rows by
their number. So the driver holds one slice and one index, beside a partition of the benchmark on its way through, and a
worker one index.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case. Nulls: null and empty texts, and items without words, match nothing; item ids may be null. Items
with equal texts each match; repeated rows come back repeated. An empty table gives no rows. All columns of the documents are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import words
from stayline.llm.scratch import stage

LEAST, ALIKE = 13, 0.75
MASKS = ("1110111", "111101001", "100101111", "110010001011", "1110000111", "101000100111")
# seeds, or words of alignments, that are compared at once
HELD = 1 << 20
_HIT = pa.struct([(n, pa.int64()) for n in ("item_id", "matched_words", "overlap_words", "item_words", "first_word")])

_HITS = f"array<struct<{', '.join(f'{f.name}: long' for f in _HIT)}>>"


def positions(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def seeds(hashed: np.ndarray, mask: str) -> np.ndarray:
    """The hash under a mask at each place where the mask fits."""
    n = len(hashed) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in positions(mask):
        total += hashed[i : i + n] * words.STEPS[i]
    return words.mix(total)


def folded_words(text: bytes) -> np.ndarray:
    """Word hashes of the lower-cased text; only texts beyond ASCII need more than the hash's own folding."""
    return words.hashes(text if text.isascii() else text.decode().lower().encode(), words.PLAIN)


def disagreements(n: int, alike: float, least: int) -> np.ndarray:
    """Bit sets of the words that may disagree in a run of n, at most; runs that hold a shorter one of ``least`` words or more are left out."""
    most = lambda k: k - math.ceil(alike * k - 1e-9)
    sets = np.array([sum(1 << i for i in c) for c in combinations(range(n), most(n))], np.int64)
    for k in range(least, n):
        for at in range(n - k + 1):
            sets = sets[np.bitwise_count((sets >> at) & ((1 << k) - 1)) > most(k)]
    return sets


def fits(mask: str, sets: np.ndarray, n: int) -> np.ndarray:
    """Which disagreements leave room for a mask somewhere in a run of n words."""
    bits, free = sum(1 << i for i in positions(mask)), np.zeros(len(sets), bool)
    for at in range(n - len(mask) + 1):
        free |= (sets & (bits << at)) == 0
    return free


@lru_cache(256)
def covering(shortest: int, longest: int, alike: float, most: int = 6) -> tuple[str, ...]:
    """Masks of which one fits, however the words of a run of ``shortest`` to ``longest`` words disagree.

    Of the largest weight (six at most) for which choosing the mask that fits most of what is left ends with ``most`` masks.
    """
    runs = {n: disagreements(n, alike, shortest) for n in range(shortest, longest + 1)}
    for weight in range(6, 0, -1):
        shapes = [
            "".join("1" if i in (0, span - 1, *inner) else "0" for i in range(span))
            for span in range(weight, min(shortest, 12) + 1) for inner in combinations(range(1, span - 1), max(weight - 2, 0)) if weight > 1 or span == 1
        ]
        left, chosen = runs, []
        while any(len(v) for v in left.values()) and len(chosen) < most and shapes:
            mask = max(shapes, key=lambda m: sum(int(fits(m, v, n).sum()) for n, v in left.items()))
            chosen.append(mask)
            left = {n: v[~fits(mask, v, n)] for n, v in left.items()}
        if chosen and not any(len(v) for v in left.values()):
            return tuple(chosen)
    return ("1",)


def masks_for(n: int, least: int = LEAST, alike: float = ALIKE) -> tuple[str, ...]:
    """The masks that find every overlap with an item of n words."""
    if n < least:
        return covering(n, n, alike)
    return MASKS if least >= LEAST and alike >= ALIKE else covering(least, 2 * least - 1, alike)


def build_index(items: list[tuple[int | None, str | None]], least: int = LEAST, alike: float = ALIKE) -> dict:
    """The items of a slice: ids, words, and for each mask the sorted window hashes with item and place."""
    hashed = [(i, folded_words((t or "").encode())) for i, t in items]
    hashed = [(i, h) for i, h in hashed if len(h)]
    of: dict[str, list[int]] = {}
    for k, (_, h) in enumerate(hashed):
        for mask in masks_for(len(h), least, alike):
            of.setdefault(mask, []).append(k)
    tables = []
    for mask, own in of.items():
        found = [seeds(hashed[k][1], mask) for k in own]
        values = np.concatenate(found)
        if not len(values):
            continue
        item = np.concatenate([np.full(len(s), k) for s, k in zip(found, own)])
        place = np.concatenate([np.arange(len(s)) for s in found])
        order = np.argsort(values, kind="stable")
        # most windows of a document fall out at this small table of hash prefixes
        seen = np.zeros(1 << 20, bool)
        seen[values >> np.uint64(44)] = True
        tables.append((mask, seen, values[order], item[order], place[order]))
    return {"ids": [i for i, _ in hashed], "words": [h for _, h in hashed], "tables": tables}


def hits(index: dict, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items and where in the document their first word would stand, for every seed in common: distinct, in order."""
    found = []
    for mask, seen, values, item, place in index["tables"]:
        own = seeds(hashed, mask)
        at = np.flatnonzero(seen[own >> np.uint64(44)])
        if not len(at):
            continue
        low = np.searchsorted(values, own[at], "left")
        n = np.searchsorted(values, own[at], "right") - low
        real = n > 0
        if not real.any():
            continue
        at, low, n = at[real], low[real], n[real]
        ends = np.cumsum(n)
        # each seed of the document beside all equal ones of the index, a bounded number at once
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(ends // HELD)) + 1) if ends[-1] > HELD else (slice(None),):
            counts = n[part]
            entry = np.repeat(low[part] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            # one number for item and place
            found.append((item[entry] << 40) + (np.repeat(at[part], counts) - place[entry] + (1 << 39)))
            if len(entry) > HELD // 8:
                found[-1] = np.unique(found[-1])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate(found))
    return pairs >> 40, (pairs & ((1 << 40) - 1)) - (1 << 39)


def overlaps(index: dict, text: bytes, least: int, alike: float) -> list[dict]:
    """The best overlap with each item that contaminates a text: most words agree, then the shorter run, then the earlier."""
    hashed, out = folded_words(text), []
    of, shifts = hits(index, hashed)
    edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else [0]
    for a, b in zip(edges, edges[1:]):
        k, own, best = int(of[a]), shifts[a:b], None
        item = index["words"][k]
        need = min(least, len(item))
        # alignments that agree in most words come first; the rest is not looked at once it can't be better
        parts = -(-len(own) * len(item) // HELD)
        totals = _agreeing(item, hashed, own) if parts == 1 else np.concatenate([_agreeing(item, hashed, p) for p in np.array_split(own, parts)])
        own, totals = own[totals >= alike * need], totals[totals >= alike * need]
        order = np.lexsort((own, -totals))
        for total, shift in zip(totals[order].tolist(), own[order].tolist()):
            if best and (total < best[0] or total == best[0] == -best[1]):
                break
            first, last = max(0, -shift), min(len(item), len(hashed) - shift)
            same = item[first:last] == hashed[shift + first : shift + last]
            run = overlap(same, need, alike)
            if run:
                start, end = run
                new = (int(same[start:end].sum()), start - end, -(shift + first + start))
                best = max(best, new) if best else new
        if best:
            out.append({"item_id": index["ids"][k], "matched_words": best[0], "overlap_words": -best[1], "item_words": len(item), "first_word": -best[2]})
    return out


def _agreeing(item: np.ndarray, hashed: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many words of an item agree with the document, for each place of its first word."""
    at = shifts[:, None] + np.arange(len(item))
    return ((hashed[np.clip(at, 0, len(hashed) - 1)] == item) & (at >= 0) & (at < len(hashed))).sum(axis=1)


def overlap(same: np.ndarray, least: int, alike: float) -> tuple[int, int] | None:
    """The run that makes an overlap, if any run of ``least`` words or more agrees in ``alike`` of them."""
    if len(same) < least or same.sum() < alike * least:
        return None
    start, end = top_run(same)
    if end - start >= least and same[start:end].sum() >= alike * (end - start):
        return start, end
    return long_run(same, least, alike)


def top_run(same: np.ndarray) -> tuple[int, int]:
    """The run with the highest score, a match 1 and a mismatch -2; the first of the longest on a tie."""
    sums = np.concatenate(([0], np.cumsum(np.where(same, 1, -2))))
    start, end, _ = _best(sums, 0)
    return start, end


def long_run(same: np.ndarray, least: int, alike: float) -> tuple[int, int] | None:
    """Of the runs of ``least`` words or more the one with the most matches above ``alike`` of its words, if any reaches it."""
    # rounded, as sums that are equal must compare as equal
    sums = np.round(np.concatenate(([0], np.cumsum(same))) - alike * np.arange(len(same) + 1), 9)
    start, end, above = _best(sums, least)
    return (start, end) if above > -1e-6 else None


def _best(sums: np.ndarray, least: int) -> tuple[int, int, float]:
    """Start, end and rise of the run of ``least`` or more steps over which running sums rise most; the first of the longest on a tie."""
    n = len(sums) - least
    lows = np.minimum.accumulate(sums[:n])
    # where the lowest sum so far stood first
    starts = np.maximum.accumulate(np.where(np.concatenate(([True], lows[1:] < lows[:-1])), np.arange(n), 0))
    rises = np.round(sums[least:] - lows, 9)
    ends = np.flatnonzero(rises == rises.max())
    k = int(ends[np.argmax(ends - starts[ends])])
    return int(starts[k]), k + least, float(rises[k])


def slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in turn, at most ``slice_bytes`` of text at a time (or one longer item)."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        n = len((row["text"] or "").encode())
        if held and size + n > slice_bytes:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += n
    yield held


def _searcher(index: Broadcast, least: int, alike: float):
    def search(texts: pa.Array) -> pa.Array:
        return pa.array([overlaps(index.value, t, least, alike) for t in words.texts(texts)], pa.list_(_HIT))

    return F.arrow_udf(search, _HITS).asNondeterministic()


def with_hits(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, alike: float = ALIKE, slice_bytes: int = 8 << 20, column: str = "contamination") -> DataFrame:
    """All columns of ``docs`` and one more: an array of the items that each text overlaps, with the overlap."""
    sc, parts = docs.sparkSession.sparkContext, slices(benchmark, slice_bytes)
    search = lambda sent: _searcher(sent, least, alike)(F.col("text").cast("string"))
    first, second = next(parts), next(parts, None)
    if second is None:
        return docs.withColumn(column, search(sc.broadcast(build_index(first, least, alike))))
    held = stage(docs.withColumn("llm_row", F.monotonically_increasing_id()), "decontaminate-rows")
    tables = []
    for n, part in enumerate(chain((first, second), parts)):
        sent = sc.broadcast(build_index(part, least, alike))
        found = held.select(F.col("llm_row").alias("llm_of"), F.lit(n).alias("slice"), search(sent).alias("hits")).filter("size(hits) > 0")
        tables.append(stage(found, "decontaminate-hits"))
        sent.destroy()
    # a document's hits in the order of the slices
    found = reduce(DataFrame.union, tables).groupBy("llm_of").agg(F.array_sort(F.collect_list(F.struct("slice", "hits"))).alias("llm_hits_of"))
    hits_of = F.coalesce(F.flatten("llm_hits_of.hits"), F.array().cast(_HITS))
    return held.join(found, F.col("llm_row") == F.col("llm_of"), "left").withColumn(column, hits_of).drop("llm_row", "llm_of", "llm_hits_of")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document and item."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, **options)
    return found.select("doc_id", F.explode("contamination").alias("hit")).select("doc_id", "hit.*")
