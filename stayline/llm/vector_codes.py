"""Product codes of vectors by ball k-means.

A vector is cut into equal consecutive parts; each part position has a codebook of a few entries, fitted by Lloyd rounds in whole
numbers. A round is exact, but seldom compares a part with all entries. The parts of one entry form a ball around it:

- *Neighbours*: only entries within twice the ball's radius can take a part away from it.
- *Stable core*: a part that lies closer to its entry than half the way to the entry's nearest neighbour stays.
- *Rings*: neighbours are sorted by distance; a part outside the core is compared with those within twice its own distance.
- *Stable ball*: if neither its entry nor any entry within twice its radius has moved, no distance is computed at all.

Vectors are packed into blocks, written once, bucketed by block. A round joins them with the small table of their codes and radii,
which is bucketed alike, so no vector is shuffled; each task adds up its blocks and sends one row per entry. What reaches the driver
and is sent to the tasks is the codebooks. Sums are whole numbers, so neither order nor partitioning changes a code.

Components become floor(scale * x). Rows are dropped if their vector is null or holds null or non-finite components. The length that
counts is that of the row with the smallest id; rows of another length have a null code and null errors. Codebooks start from the rows
with the smallest ids (nulls last; of equal ids the smaller vector); with fewer rows they have fewer entries. Components are held to
+-2^27 after scaling, so that no sum of squares overflows. Repeated rows count once each. An empty table gives no rows, and a length
that ``parts`` doesn't divide is an error. Only ``vec_id, embedding, label`` are read; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import session
from stayline.llm.scratch import stage

LIMIT = 1 << 27
Codebooks = np.ndarray  # parts x entries x width, int64


def whole_vectors(df: DataFrame, scale: int = 4096) -> DataFrame:
    """``vec_id, label, x``: the rows that count, with whole-number components."""
    value = lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    finite = lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    kept = df.filter(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return kept.select("vec_id", "label", F.transform("embedding", value).alias("x"))


def first_entries(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the rows with the smallest ids; a few rows reach the driver."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    head = rows.select("vec_id", "x").orderBy(*order).limit(1).collect()
    if not head:
        return None
    width = len(head[0]["x"])
    if width == 0 or width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    first = rows.filter(F.size("x") == width).select("vec_id", "x").orderBy(*order).limit(entries).collect()
    return np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()


def reassign(x: np.ndarray, codes: np.ndarray, radii: np.ndarray | None, old: np.ndarray | None, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Exact nearest entries of one part position, from any earlier assignment: codes, squared radii, and distances computed.

    ``x`` is rows x width; ``radii`` bounds the squared distance of each entry's rows to it as it was in ``old``. Without them
    every ball is measured.
    """
    gaps = ((new[:, None, :] - new[None, :, :]) ** 2).sum(axis=2)
    moved = np.ones(len(new), bool) if old is None else (old != new).any(axis=1)
    codes, after, work = codes.copy(), np.full(len(new), -1, np.int64), 0
    before = codes.copy()
    for j in np.unique(before):
        order = np.argsort(gaps[j], kind="stable")
        order = order[order != j]
        reach = gaps[j][order]
        if radii is not None and not moved[j] and not moved[order[: np.searchsorted(reach, 4 * radii[j], side="right")]].any():
            after[j] = max(after[j], radii[j])
            continue
        own = np.flatnonzero(before == j)
        best = ((x[own] - new[j]) ** 2).sum(axis=1)
        work += len(own)
        entry = np.full(len(own), j)
        # an entry farther away than twice the distance can't be nearer, one at twice the distance can be as near
        ring = np.searchsorted(reach, 4 * best, side="right")
        for t in range(int(ring.max(initial=0))):
            at = np.flatnonzero(ring > t)
            other = order[t]
            far = ((x[own[at]] - new[other]) ** 2).sum(axis=1)
            work += len(at)
            wins = (far < best[at]) | ((far == best[at]) & (other < entry[at]))
            best[at[wins]], entry[at[wins]] = far[wins], other
        codes[own] = entry
        np.maximum.at(after, entry, best)
    return codes, after, work


def _pack(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors: their components as int32 bytes, with ids and labels beside them."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x = part.column(2).flatten().cast(pa.int32()).to_numpy(zero_copy_only=False)
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), pa.ListArray.from_arrays(ends, part.column(0)), pa.ListArray.from_arrays(ends, part.column(1)), pa.array([x.tobytes()], pa.binary())],
                    ["n", "vec_ids", "labels", "x"],
                )

    schema = f"n int, vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, x binary"
    return rows.filter(F.size("x") == width).select("vec_id", "label", "x").mapInArrow(pack, schema).withColumn("block", F.monotonically_increasing_id())


class Blocks:
    """Packed vectors on shared storage and the present codes of each block, bucketed alike."""

    def __init__(self, rows: DataFrame, width: int, size: int, buckets: int | None) -> None:
        self.spark = rows.sparkSession
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[str, str] = {}
        self.vectors = self._placed(_pack(rows, width, size).repartition(self.buckets, "block"), "vectors")

    def _placed(self, df: DataFrame, label: str) -> DataFrame:
        name, path = f"{label}_{uuid.uuid4().hex}", session.scratch_path(self.spark, label)
        df.write.bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        self.tables[name] = path
        return self.spark.table(name)

    def _with(self, state: DataFrame, *columns: str) -> DataFrame:
        """Vectors with columns of their block's state: bucket meets bucket, and only the small side is held in memory."""
        return self.vectors.join(state.select("block", *columns).hint("shuffle_hash"), "block")

    def step(self, state: DataFrame | None, old: Codebooks | None, new: Codebooks) -> DataFrame:
        """``block, codes, radii, sums``: every part with its nearest entry of ``new``, written to shared storage."""
        sent = self.spark.sparkContext.broadcast((old, new))
        if state is None:
            joined = self.vectors.select("block", "n", "x", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("radii"))
        else:
            joined = self._with(state, "codes", "radii").select("block", "n", "x", "codes", "radii")

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            old, new = sent.value
            parts, entries, width = new.shape
            for batch in batches:
                for i in range(batch.num_rows):  # one block at a time: a batch may hold many
                    block, n, x, codes, radii = (c[i].as_py() for c in batch.columns)
                    x = np.frombuffer(x, np.int32).reshape(n, parts, width).astype(np.int64)
                    known = codes is not None
                    codes = np.frombuffer(codes, np.int16).reshape(n, parts) if known else np.zeros((n, parts), np.int16)
                    radii = np.frombuffer(radii, np.int64).reshape(parts, entries) if known else [None] * parts
                    after, reach = np.empty_like(codes), np.empty((parts, entries), np.int64)
                    sums = np.zeros((parts, entries, width + 1), np.int64)
                    for p in range(parts):
                        after[:, p], reach[p], _ = reassign(x[:, p], codes[:, p], radii[p], old[p] if known else None, new[p])
                        np.add.at(sums[p, :, :width], after[:, p], x[:, p])
                        sums[p, :, width] = np.bincount(after[:, p], minlength=entries)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([after.tobytes()], pa.binary()), pa.array([reach.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())],
                        ["block", "codes", "radii", "sums"],
                    )

        return self._placed(joined.mapInArrow(assign, "block long, codes binary, radii binary, sums binary"), "vector_codes")

    def refit(self, state: DataFrame, books: Codebooks) -> Codebooks:
        """Entries at the floored means of their parts; one row per entry and task is shuffled."""
        shape = (*books.shape[:2], books.shape[2] + 1)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.int64)
            for batch in batches:
                for sums in batch.column(0).to_pylist():
                    total += np.frombuffer(sums, np.int64).reshape(shape)
            p, e = np.nonzero(total[:, :, -1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "sums"]
            )

        totals = state.select("sums").mapInArrow(add, "part int, entry int, sums array<long>").groupBy("part", "entry").agg(
            F.array(*[F.sum(F.col("sums")[i]) for i in range(shape[2])]).alias("sums")
        )
        after = books.copy()
        for r in totals.collect():
            after[r["part"], r["entry"]] = [s // r["sums"][-1] for s in r["sums"][:-1]]
        return after

    def codes(self, state: DataFrame, books: Codebooks) -> DataFrame:
        """``vec_id, label, code, error``: codes in hex and squared distances summed over the parts."""
        sent = self.spark.sparkContext.broadcast(books)
        kinds = {f.name: f.dataType.elementType.simpleString() for f in self.vectors.schema if f.name in ("vec_ids", "labels")}

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = sent.value
            parts, entries, width = books.shape
            digits = 2 if entries <= 256 else 4
            for batch in batches:
                for i in range(batch.num_rows):
                    n = batch.column(0)[i].as_py()
                    x = np.frombuffer(batch.column(3)[i].as_py(), np.int32).reshape(n, parts, width).astype(np.int64)
                    codes = np.frombuffer(batch.column(4)[i].as_py(), np.int16).reshape(n, parts)
                    error = ((x - books[np.arange(parts), codes]) ** 2).sum(axis=(1, 2))
                    raw = (codes.astype(np.uint8) if digits == 2 else codes.astype(">u2")).tobytes().hex()
                    each = parts * digits
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1)[i].values, batch.column(2)[i].values, pa.array([raw[k * each : k * each + each] for k in range(n)], pa.string()), pa.array(error)],
                        ["vec_id", "label", "code", "error"],
                    )

        joined = self._with(state, "codes").select("n", "vec_ids", "labels", "x", "codes")
        return joined.mapInArrow(read, f"vec_id {kinds['vec_ids']}, label {kinds['labels']}, code string, error long")

    def forget(self) -> None:
        """Drop the tables and their files; nothing may read them later."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for name, path in self.tables.items():
            self.spark.sql(f"drop table {name}")
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def compress(
    df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, block: int = 8192, buckets: int | None = None
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` per row that counts, and the codebooks."""
    rows = whole_vectors(df, scale)
    books = first_entries(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), np.empty((parts, 0, 0), np.int64)
    width = books.shape[0] * books.shape[2]
    blocks = Blocks(rows, width, block, buckets)
    state, old = None, None
    for _ in range(rounds):
        state = blocks.step(state, old, books)
        old, books = books, blocks.refit(state, books)
    state = blocks.step(state, old, books)
    odd = rows.filter(F.size("x") != width).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = stage(blocks.codes(state, books).unionByName(odd), "vector-results")
    blocks.forget()
    return coded, books


def listing(books: Codebooks) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(v) for v in books.ravel().tolist())


def digest(coded: DataFrame, books: Codebooks) -> DataFrame:
    """The digest columns. Errors are summed per label before the labels meet their rows, so a common label is one row of the sums."""
    total = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(total, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(listing(books).encode()).hexdigest()).alias("codebooks_sha256"),
    )
