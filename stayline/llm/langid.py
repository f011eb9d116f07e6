"""Language identification by the nearest of several centroids per language.

A text becomes a vector of character 1- to 3-grams hashed to ``SIZE`` columns: logarithmic counts, weighted by inverse document
frequency, scaled to length one. Document frequencies come from all training rows. The centroids of a language are the
clusters of a sample of its vectors (spherical k-means, ``clusters`` per language, from at most about ``sample`` rows per
language and ``most`` in all; both are parameters, and every language has one row at least). A text gets the language of the centroid with the largest cosine.

Rejection: short texts are farther from every centroid than long ones, so the bound is the smallest cosine that the sample has
for each doubling of length below 2**LONG characters, at most ``shrink`` times that of twice the length; a text is rejected if its cosine is below
``slack`` times the bound of its length, or if it has no letter.

Nulls: null texts, empty texts and texts without a letter get ``und``, score 0 and are rejected. Rows whose language is
null teach nothing. Without any training row all texts get ``und``. Repeated rows count as often as they occur. An empty
table gives no rows. All columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.scratch import stage

SIZE = 4096
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_SHIFT = np.uint32(32 - SIZE.bit_length() + 1)
RESULT = "lang: string, score: double, rejected: boolean"
_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
LENGTHS, LONG = 32, 10
# letters of the basic plane; characters beyond it count as letters
LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that is kept for testing; a null id is not held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def grams(text: str) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of the lower-cased letters; whatever stands between words is one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    letter = LETTER[np.minimum(points, len(LETTER) - 1)]
    points = np.where(letter, points, np.uint32(32))[np.concatenate(([True], letter[1:] | letter[:-1]))]
    one = points * _MULT[0]
    two = one[:-1] + points[1:] * _MULT[1]
    three = two[:-1] + points[2:] * _MULT[2]
    total = np.zeros(SIZE, np.int64)
    for n, g in enumerate((one, two, three)):
        g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        total += np.bincount((g >> _SHIFT).astype(np.int64), minlength=SIZE)
    return total


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(grams(text)).astype(np.float32) * idf
    length = float(np.sqrt(v @ v))
    return v / np.float32(length) if length else v


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _doubling(text: str) -> int:
    return min(len(text).bit_length(), LENGTHS - 1)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many of the texts hold each hashed n-gram; one row per column and task, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[:SIZE] += grams(text or "") > 0
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1)), pa.array(total)], names=["g", "n"])

    total = np.zeros(SIZE + 1, np.int64)
    for r in texts.mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        total[r["g"]] = r["n"]
    return total[:SIZE], int(total[-1])


def clustered(vectors: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of spherical k-means, started from vectors spread evenly over the order of their cosine to the mean."""
    typical = np.argsort(vectors @ vectors.mean(axis=0), kind="stable")
    k = min(clusters, len(vectors))
    centroids = vectors[typical[[(2 * i + 1) * len(vectors) // (2 * k) for i in range(k)]]].copy()
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                m = vectors[own == c].mean(axis=0)
                centroids[c] = m / max(float(np.sqrt(m @ m)), 1e-12)
    # a cluster of a few odd texts is no pattern of the language
    share = np.bincount(np.argmax(vectors @ centroids.T, axis=1), minlength=len(centroids))
    return centroids[share >= min(share.max(), 0.03 * len(vectors))]


def fit(training: DataFrame, clusters: int = 4, sample: int = 300, most: int = 3000, slack: float = 0.5, shrink: float = 0.7, seed: int = 3) -> dict | None:
    """A model from ``text, lang`` rows (and ``doc_id``, by which the sample is drawn)."""
    rows = training.filter("lang is not null and text is not null").select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    # the row of the least draw is always taken, so that no language is lost to chance
    sizes = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least")), "langid-sizes")
    count = sizes.count()
    if not count:
        return None
    frequencies, n = document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + frequencies)).astype(np.float32) + np.float32(0.05)
    each = max(1, min(sample, most // count))
    limits = sizes.select("lang", "least", (F.lit(float(each)) / F.col("n")).alias("limit"))

    def as_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([vector(t, idf).tobytes() for t in texts], pa.binary()), batch.column(1), pa.array([_doubling(t) for t in texts], pa.int32()), pa.array([has_letter(t) for t in texts])],
                names=["v", "lang", "doubling", "letters"],
            )

    drawn_rows = rows.withColumn("draw", draw).join(limits, "lang").filter("draw < limit or draw = least")
    taken = drawn_rows.select("text", "lang").mapInArrow(as_vectors, "v binary, lang string, doubling int, letters boolean")
    drawn = sorted((r["lang"], r["v"], r["doubling"]) for r in taken.collect() if r["letters"])
    languages, parts, near = [], [], {}
    for lang in sorted({d[0] for d in drawn}):
        vectors = np.stack([np.frombuffer(d[1], np.float32) for d in drawn if d[0] == lang])
        centroids = clustered(vectors, clusters)
        languages += [lang] * len(centroids)
        parts.append(centroids)
        for (_, _, doubling), cosine in zip((d for d in drawn if d[0] == lang), (vectors @ centroids.T).max(axis=1).tolist()):
            near[doubling] = min(near.get(doubling, 1.0), cosine)
    if not parts:
        return None
    # one bound from LONG on; below it, from long to short, a text of half the length may lie farther away, seen or not
    floors, last = [0.0] * LENGTHS, min((c for d, c in near.items() if d >= LONG), default=min(near.values()))
    for doubling in range(LENGTHS - 1, -1, -1):
        if doubling < LONG:
            last = min(near.get(doubling, 1.0), shrink * last)
        floors[doubling] = slack * last
    return {"idf": idf, "centroids": np.concatenate(parts), "languages": languages, "floors": floors}


def _predictor(model: Broadcast):
    def predict(texts: pa.Array) -> pa.Array:
        m, out = model.value, []
        for text in texts.to_pylist():
            if m is None or not text or not has_letter(text):
                out.append({"lang": "und", "score": 0.0, "rejected": True})
                continue
            cosines = m["centroids"] @ vector(text, m["idf"])
            best = int(np.argmax(cosines))
            score = min(1.0, max(0.0, float(cosines[best])))
            out.append({"lang": m["languages"][best], "score": score, "rejected": score < m["floors"][_doubling(text)]})
        return pa.array(out, _RESULT)

    return F.arrow_udf(predict, f"struct<{RESULT}>").asNondeterministic()


def identify(docs: DataFrame, model: dict | None, column: str = "language") -> DataFrame:
    """All columns of ``docs`` and one more: the predicted language, its cosine, and whether it is too far from all."""
    return docs.withColumn(column, _predictor(docs.sparkSession.sparkContext.broadcast(model))(F.col("text").cast("string")))
