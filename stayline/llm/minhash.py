"""Near-duplicates by b-bit MinHash, exact links, and connected components.

1. A document's set is its distinct word shingles. ``n_hashes`` minima are taken over the set; bands of ``rows`` minima give
   bucket keys, and the low ``BITS`` bits of all minima are packed into a sketch.
2. Documents with equal sets share one node. Nodes that share a bucket are candidates. Two minima agree with probability
   J + (1 - J) / 2**BITS, so the number of differing positions in two sketches, by bit counts, gives an estimate of J that is
   corrected for chance collisions; candidates far below the threshold go.
3. What remains is confirmed on the full sets, and links join components.

Buckets may hold any number of nodes and no pairs of a whole group are ever listed. First each node meets only the smallest
node of its buckets. After that, pairs inside one component no longer matter: in a bucket whose nodes lie in several
components, the nodes outside its largest component meet all others in blocks, first by sketch, then on full sets, and only
links come out. So every candidate pair is either inside a component or tested, and the components are those of all
candidate pairs. A link that shares no bucket is missed with a probability of about (1 - t**rows)**bands at the threshold t:
below one in a million for the defaults of ``bands_for``.

Nulls: null and empty texts and texts without words have an empty set, take part in no link and are their own component. A
text with fewer words than a shingle is one shingle. Rows that share a doc_id are one document whose links are pooled; repeated
rows come back repeated. A null doc_id is never linked. An empty table gives no rows. Other columns are kept or ignored as stated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import words
from stayline.llm.components import components
from stayline.llm.scratch import stage

BITS = 2
_rng = np.random.default_rng(5)
_SPREAD = _rng.integers(0, 1 << 32, 512, dtype=np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, 512, dtype=np.uint32)
_EVEN = np.uint64(0x5555555555555555)

SIGNATURE = "doc_id long, n_shingles long, set_id binary, keys array<long>, sketch array<long>"
_SIGNATURE = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
])


def bands_for(percent: int, miss: float = 1e-6, most: int = 128) -> tuple[int, int]:
    """Bands and rows per band: the longest bands with which a pair at the threshold is missed with at most this probability."""
    t = percent / 100
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(miss) / math.log(1 - t**rows)) if t < 1 else 1
        if bands * rows <= most:
            return bands, rows
    return most, 1


def minima(shingles: np.ndarray, n_hashes: int) -> np.ndarray:
    """The smallest value of each hash function over a set of shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(n_hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        part = x[at : at + 2048, None] * _SPREAD[None, :n_hashes]
        part ^= _SHIFT[None, :n_hashes]
        np.minimum(best, part.min(axis=0), out=best)
    return best


def band_keys(best: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket key per band; the band's number is part of the key."""
    return words.windows(best[: bands * rows].astype(np.uint64), rows)[::rows] ^ words.STEPS[0] * np.arange(1, bands + 1, dtype=np.uint64)


def sketch(best: np.ndarray) -> np.ndarray:
    """The low bits of the (mixed) minima, packed 32 to a number."""
    low = words.mix(best.astype(np.uint64) + words.STEPS[1] * np.arange(len(best), dtype=np.uint64)) & np.uint64((1 << BITS) - 1)
    padded = np.zeros(-(-len(low) // 32) * 32, np.uint64)
    padded[: len(low)] = low
    return np.bitwise_or.reduce(padded.reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def most_differing(percent: int, n_hashes: int, sigmas: float = 5.0) -> int:
    """How many positions of two sketches may differ before the pair is given up: the mean at the threshold and five deviations."""
    p = (1 - percent / 100) * (1 - 0.5**BITS)
    return math.ceil(n_hashes * p + sigmas * math.sqrt(n_hashes * p * (1 - p)))


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, set_id, keys, sketch`` of whole texts; keys and sketch are empty for empty sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        for batch in batches:
            sizes, ids, keys, sketches = [], [], [], []
            for text in words.texts(batch.column(1)):
                found = words.shingles(words.hashes(text), width)
                sizes.append(len(found))
                ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                best = minima(found, bands * rows) if len(found) else None
                keys.append(none if best is None else band_keys(best, bands, rows))
                sketches.append(none if best is None else sketch(best))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), words.long_lists(keys), words.long_lists(sketches)], schema=_SIGNATURE
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, SIGNATURE)


def _apart(a: str, b: str, longs: int):
    """Number of positions in which two sketches differ."""
    return sum(
        (F.bit_count((x := F.col(a)[i].bitwiseXOR(F.col(b)[i])).bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))) for i in range(longs)),
        F.lit(0),
    )


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int, block: int = 512) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets are similar enough.

    Every pair travels to its ``b``: the text of b comes first and is kept as a set, the texts of the a's stream past it. A
    b with many partners is dealt out in blocks of about ``block`` of them, each with its own copy of b's text.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    dealt = pairs.join(counts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).alias("block"))
    roles = dealt.select(F.col("a").alias("doc_id"), "b", "block", F.lit(1).alias("side")).union(
        dealt.select(F.col("b").alias("doc_id"), "b", "block", F.lit(0).alias("side")).distinct()
    )
    rows = roles.join(texts, "doc_id").repartition("b", "block").sortWithinPartitions("b", "block", "side")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centres = None, []
        for batch in batches:
            left, right = [], []
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
            for (doc, b, blk, side), text in zip(keys, words.texts(batch.column(4))):
                if (b, blk) != at:
                    at, centres = (b, blk), []
                own = words.shingles(words.hashes(text), width)
                if side == 0:
                    centres.append(own)
                    continue
                for centre in centres:
                    if 100 * min(len(own), len(centre)) < percent * max(len(own), len(centre)):
                        continue
                    both = len(np.intersect1d(own, centre, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(centre) - both):
                        left.append(doc)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return rows.select("doc_id", "b", "block", "side", "text").mapInArrow(test, "a long, b long")


def _meet(rows: DataFrame, wide: str, tall: str, columns: list[str]) -> DataFrame:
    """Deal the rows of open buckets into blocks in which every odd row meets every row, once each.

    ``side`` 1 is a block's share of all rows, side 0 its share of the odd ones, which come after.
    """
    one = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    parts = rows.filter("odd").select("key", one(tall).alias("y"), each(wide).alias("x"), F.lit(0).alias("side"), *columns).union(
        rows.select("key", each(tall).alias("y"), one(wide).alias("x"), F.lit(1).alias("side"), *columns)
    )
    return parts.repartition("key", "y", "x").sortWithinPartitions("key", "y", "x", F.desc("side"))


def _fitting(rows: list[tuple], percent: int, limit: int):
    """For the rows of a block (node, component, size, sketch): which of them a given row may be linked to in another component."""
    node, comp, size = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    bits = np.array([r[3] for r in rows], np.int64).view(np.uint64)

    def of(n: int, c: int, s: int, k: list[int]) -> np.ndarray:
        x = bits ^ np.array(k, np.int64).view(np.uint64)
        apart = np.bitwise_count((x | (x >> np.uint64(1))) & _EVEN).sum(axis=1)
        return (apart <= limit) & (comp != c) & (node != n) & (100 * np.minimum(size, s) >= percent * np.maximum(size, s))

    return of


def open_rows(multi: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, limit: int, block: int = 2048) -> DataFrame:
    """``key, node`` of the rows that have a candidate of another component in their bucket, by sketch.

    Only the rows outside a bucket's largest component (odd rows) are compared with the others; what comes out are rows, not pairs.
    """
    placed = multi.join(labels, "node").select("key", "node", "component")
    groups = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    open_ = (
        groups.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), F.max(F.struct("n", "component")).alias("top"))
        .filter("kinds > 1")
        .select("key", F.col("top.component").alias("largest"), F.ceil(F.col("total") / block).alias("wide"), F.ceil((F.col("total") - F.col("top.n")) / block).alias("tall"))
    )
    rows = placed.join(open_, "key").join(nodes.select("node", "n_shingles", "sketch"), "node").withColumn("odd", F.col("component") != F.col("largest"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, all_, hit, fitting = None, [], None, None

        def out(rows: list[tuple[int, int, bool]]) -> pa.RecordBatch:
            key, node, odd = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(node, pa.int64()), pa.array(odd, pa.bool_())], names=["key", "node", "odd"])

        def closed() -> list[tuple[int, int, bool]]:
            return [(at[0], all_[i][0], False) for i in np.flatnonzero(hit).tolist()] if hit is not None else []

        for batch in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:3] != at:
                    rows += closed()
                    at, all_, hit = r[:3], [], None
                if r[3]:
                    all_.append(r[4:])
                    continue
                if hit is None:
                    if not all_:
                        continue
                    hit, fitting = np.zeros(len(all_), bool), _fitting(all_, percent, limit)
                fit = fitting(*r[4:])
                if fit.any():
                    hit |= fit
                    rows.append((at[0], r[4], True))
            yield out(rows)
        yield out(closed())

    met = _meet(rows, "wide", "tall", ["node", "component", "n_shingles", "sketch"])
    return met.mapInArrow(search, "key long, node long, odd boolean").groupBy("key", "node").agg(F.max("odd").alias("odd"))


def cross_links(rows: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int, limit: int, block: int = 256, stream: int = 1024) -> DataFrame:
    """Links ``a, b`` between components among open rows, on full sets; one for each row, other component and block is enough.

    A pair that shares several buckets is tested in the first of them only. A block's sets form one inverted list, past which
    the odd rows stream, so that a task holds ``block`` sets however large a bucket is.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).alias("wide"), F.greatest(F.lit(1), F.ceil(F.sum(F.col("odd").cast("long")) / stream)).alias("tall"))
    full = rows.join(sizes, "key").join(labels, "node").join(nodes, "node").join(texts.withColumnRenamed("doc_id", "node"), "node")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, all_, sets, lists, done = None, [], [], None, set()
        for batch in batches:
            left, right = [], []
            for r, text in zip(zip(*(c.to_pylist() for c in batch.columns[:-1])), words.texts(batch.column(batch.num_columns - 1))):
                if r[:3] != at:
                    at, all_, sets, lists = r[:3], [], [], None
                own = words.shingles(words.hashes(text), width)
                if r[3]:
                    all_.append(r[4:])
                    sets.append(own)
                    continue
                if lists is None:
                    if not all_:
                        continue
                    flat = np.concatenate(sets)
                    order = np.argsort(flat, kind="stable")
                    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
                    lists = flat[order], owner, np.array([len(s) for s in sets]), np.array([m[4] for m in all_], np.int64), _fitting(all_, percent, limit)
                values, owner, size, keys, fitting = lists
                node, comp, n, bits, mine = r[4:]
                shared = keys == np.array(mine, np.int64)
                first = keys[np.arange(len(keys)), shared.argmax(axis=1)] == at[0]
                fit = fitting(node, comp, n, bits) & first
                if not fit.any():
                    continue
                low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                n_hits = high - low
                places = np.repeat(high - np.cumsum(n_hits), n_hits) + np.arange(n_hits.sum())
                both = np.bincount(owner[places], minlength=len(size))
                linked = np.flatnonzero(fit & (100 * both >= percent * (len(own) + size - both)))
                done = set()
                for i in linked.tolist():
                    if all_[i][1] not in done:
                        done.add(all_[i][1])
                        left.append(max(node, all_[i][0]))
                        right.append(min(node, all_[i][0]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    met = _meet(full, "wide", "tall", ["node", "component", "n_shingles", "sketch", "keys", "text"])
    return met.mapInArrow(test, "a long, b long").distinct()


def near_components(docs: DataFrame, width: int = 5, percent: int = 80, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets; ``component_id`` is the smallest
    doc_id reachable over links, and ``kept`` is true for that document.
    """
    if bands is None or rows is None:
        bands, rows = bands_for(percent)
    n_hashes = bands * rows
    longs, limit = -(-n_hashes // 32), most_differing(percent, n_hashes)
    signed = stage(signatures(docs, width, bands, rows), "minhash-signatures")
    full = signed.filter("n_shingles > 0 and doc_id is not null")
    sets = full.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    nodes = stage(
        full.join(sets.withColumnRenamed("node", "doc_id"), ["set_id", "doc_id"]).dropDuplicates(["set_id", "doc_id"])
        .select(F.col("doc_id").alias("node"), "n_shingles", "keys", "sketch"), "minhash-nodes",
    )
    in_bucket = nodes.select("node", F.explode("keys").alias("key"))
    centres = in_bucket.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last").drop("last")
    multi = stage(in_bucket.join(centres, "key").select("key", "node", "b"), "minhash-buckets")
    small = nodes.select("node", "n_shingles", "sketch")
    busy = multi.select(F.col("node").alias("doc_id")).distinct()
    first = (
        multi.filter("node > b").select(F.col("node").alias("a"), "b").distinct()
        .join(small.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa")), "a")
        .join(small.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb")), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).filter(_apart("sa", "sb", longs) <= limit)
        .select("a", "b").distinct()
    )
    texts = stage(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(busy, "doc_id").dropDuplicates(["doc_id", "text"]), "minhash-texts"
    )
    links = stage(confirm(first, texts, width, percent), "minhash-links")
    labels = stage(_with_all(components(links), busy), "minhash-labels")
    rows_left = stage(open_rows(multi, labels, nodes, percent, limit), "minhash-open")
    links = links.union(stage(cross_links(rows_left, labels, nodes, texts, width, percent, limit), "minhash-links"))
    labels = components(links)
    final = full.select("set_id", "doc_id").distinct().join(sets, "set_id").join(labels, "node", "left")
    # rows of one doc_id pool their links
    per_doc = final.groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles").join(per_doc, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """All columns of the rows of ``docs`` that stay: one of each component of linked rows.

    Rows are told apart by a number of their own, so rows without an id are compared as well, and rows that repeat an id stay or go
    each for its own text. Of a component the row with the smallest doc_id stays (a row without one only if none has any), of rows
    with equal ids the one whose text has the smaller digest.
    """
    row = "minhash_row"
    while row in docs.columns:
        row += "_"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "minhash-rows")
    found = near_components(numbered.select(F.col(row).alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("node"), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.col(row).alias("node"))
    members = stage(found.join(numbered.select(F.col(row).alias("node"), rank.alias("rank")), "node"), "minhash-members")
    first = members.groupBy("component_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = stage(first.select("component_id", F.col("first.node").alias("first")), "minhash-first")
    gone = members.join(first, "component_id").filter("node <> first").select(F.col("node").alias(row))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def _with_all(labels: DataFrame, busy: DataFrame) -> DataFrame:
    """Labels of all nodes that share a bucket; a node without links is its own component."""
    return (
        busy.select(F.col("doc_id").alias("node")).join(labels, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )
