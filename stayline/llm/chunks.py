"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes decides where chunks end: before ``NORMAL`` bytes a strict mask must be met, after it a
loose one, so that chunk lengths gather around the normal size. Boundaries depend on nearby bytes only and come back in step
after an insertion. A fingerprint is the set of chunk digests with their lengths, written ``digest:length`` in hex, sorted and
joined by dots. Likeness is containment by length: the share of a fingerprint's bytes whose chunks the other one has.

Nulls: a null text is empty; an empty text has the empty fingerprint, which is contained in every other and equal only to
itself: its likeness is 1 to an empty one and 0 to others. Rows with equal ids follow one another in the order of their texts;
a null id comes first. A single row is its own next one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, NORMAL, MOST = 16, 48, 192
STRICT, LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)
GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: bytes) -> np.ndarray:
    """The gear hash after each byte: ``sum gear[byte i back] << i`` over 32 bytes, by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h = longer
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(data)
    loose = np.flatnonzero((h & LOOSE) == 0) + 1
    strict = loose[(h[loose - 1] & STRICT) == 0].tolist()
    loose = loose.tolist()
    ends, at = [], 0
    while n - at > LEAST:
        end = min(at + MOST, n)
        i = bisect_left(strict, at + LEAST)
        if i < len(strict) and strict[i] < at + NORMAL:
            end = min(end, strict[i])
        else:
            i = bisect_left(loose, at + NORMAL)
            if i < len(loose):
                end = min(end, loose[i])
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> dict[int, int]:
    """Digest (48 bits) of each distinct chunk to its length."""
    found, at = {}, 0
    for end in cuts(data):
        found[xxhash.xxh3_64_intdigest(data[at:end]) >> 16] = end - at
        at = end
    return found


def render(found: dict[int, int]) -> str:
    return ".".join([f"{d:012x}:{n:x}" for d, n in sorted(found.items())])


def parse(fingerprint: str) -> dict[int, int]:
    return {int(d, 16): int(n, 16) for d, n in (c.split(":") for c in fingerprint.split("."))} if fingerprint else {}


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """The share of a fingerprint's bytes that another one has; two empty ones are alike."""
    whole = sum(own.values())
    if not whole:
        return 0.0 if other else 1.0
    return sum(n for d, n in own.items() if d in other) / whole


def fingerprint(docs: DataFrame, column: str = "text") -> DataFrame:
    """All columns of a frame with the ``fingerprint`` of one of them."""

    @F.pandas_udf("string")
    def of(texts):
        return texts.map(lambda t: render(chunks((t or "").encode())))

    return docs.withColumn("fingerprint", of(F.col(column)))


def in_order(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``bucket, last, doc_id, text``: partitions of whole buckets, rows in id order, each bucket ended by the row that follows it.

    Buckets are ranges of ids whose bounds are quantiles, so no bucket holds more than its share. The first row of each
    bucket is also sent to the bucket before (that of the first one to the last), marked ``last``. Texts are shuffled once.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    row = plain.agg(F.percentile_approx("doc_id", shares, 100 * buckets).alias("q")).first() if shares else None
    bounds = sorted({float(x) for x in (row["q"] or [])}) if row else []
    splits = [-float("inf"), *bounds, float("inf")]
    if len(splits) > 2:
        cut = Bucketizer(splits=splits, inputCol="cdc_id", outputCol="cdc_bucket", handleInvalid="keep")
        placed = cut.transform(plain.withColumn("cdc_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))))
    else:
        placed = plain.withColumn("cdc_bucket", F.lit(0.0))
    placed = placed.select(F.col("cdc_bucket").cast("int").alias("bucket"), "doc_id", "text")
    # one row per bucket: driver and broadcast sizes are those of the bucket list
    heads = placed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("head")).orderBy("bucket").collect()
    if not heads:
        return placed.select("bucket", F.lit(False).alias("last"), "doc_id", "text")
    before = [(h["head"]["doc_id"], h["bucket"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    copies = docs.sparkSession.createDataFrame(before, "head long, of int, to int")
    sent = (
        placed.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("bucket") == F.col("of")), "left")
        .withColumn("cdc_to", F.explode(F.when(F.col("to").isNull(), F.array(F.struct("bucket", F.lit(False).alias("last"))))
                                        .otherwise(F.array(F.struct("bucket", F.lit(False).alias("last")), F.struct(F.col("to").alias("bucket"), F.lit(True).alias("last"))))))
        .select("cdc_to.bucket", "cdc_to.last", "doc_id", "text")
    )
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "last", F.col("doc_id").asc_nulls_first(), "text")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the start of the next document."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: bucket, id, text, chunks
        for batch in batches:
            rows = []
            for bucket, last, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                found = chunks(text.encode())
                if held is not None and held[0] == bucket:
                    rows.append(finish(*held[1:], text, found))
                # the row that ends a bucket is there for the one before it only
                held = None if last else (bucket, doc_id, text, found)
            yield pa.RecordBatch.from_pydict(dict(zip(_RESULT.names, zip(*rows) if rows else [()] * len(_RESULT))), schema=_RESULT)

    def finish(doc_id: int, text: str, found: dict, following: str, next_found: dict) -> tuple:
        half = len(text) // 2
        data = (text[: len(text) - half] + following[:half]).encode()
        edited = chunks(data)
        return (doc_id, len(text), hashlib.sha256(data).hexdigest(), render(found), render(edited), containment(found, edited), containment(found, next_found))

    return in_order(docs, buckets).mapInArrow(compare, RESULT)


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
