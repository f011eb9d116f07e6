"""Toxicity by a classifier chain.

The categories are predicted one after the other by logistic models; each model sees the text's features and the probabilities
of the categories before it. In training those probabilities are out-of-fold ones, so that later models learn from values as uncertain
as those they will get: a row's come from models, and from marks, that were chosen and fitted without any label of its fold.

Labels give two flags, ``quality`` and ``toxic``. The chain is ``poor`` (a quality of 0), ``direct`` (toxic, and some whole word marks
it), ``severe`` (toxic, and at least three words carry a mark), ``toxic``. Without a ``quality`` column, or where it is null, no row is poor. Marks are features that are much more frequent in toxic rows: words, and beginnings of
longer words, which catch stems with changing endings. The ``features`` strongest ones by z-score enter the models, and with
them how surely the surest mark of a text means toxic, how many of its words are marked, its share of punctuation and its length. At most the
``candidates`` most frequent features of toxic rows are weighed.

The model is fitted on a sample of about ``sample`` labelled rows, drawn by a hash of their ids; marks and weights come from
that sample, whose labels are broadcast. The driver holds its inputs as lists of marks, never as a matrix. Everything else reads all
documents, whole.

Nulls: a null or empty text has probability 0 in all categories and isn't toxic. Labels that are null are ignored; if a document has
several labels the largest counts. Without labels, or with labels of one kind only, nothing is toxic. Repeated rows come
back repeated, an empty table gives no rows, all columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import words
from stayline.llm.scratch import stage

CATEGORIES = ("poor", "direct", "severe", "toxic")
SIZES = (4, 5, 6, 7, 8, 9)
EXTRA = 5
# ASCII characters that are neither letters, digits nor white space
_MARKS = np.zeros(256, bool)
_MARKS[33:128] = ~words.PLAIN[33:128]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and beginnings of a text, the word each belongs to, and its size (0: a whole word)."""
    return words.stems(text if text.isascii() else text.decode().lower().encode(), words.PLAIN, SIZES)


def count_features(sample: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """``feature, n``: how many of the texts have each feature (or each of a sorted few); summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for text in words.texts(batch.column(0)):
                found = np.unique(features(text)[0])
                own.append(found if only is None else found[only[np.minimum(np.searchsorted(only, found), len(only) - 1)] == found])
            values, n = np.unique(np.concatenate(own), return_counts=True) if own else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["feature", "n"])

    return sample.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def choose_marks(rows: DataFrame, n_rows: int, n_toxic: int, most: int, least_z: float, candidates: int = 20_000) -> list[tuple[int, float]]:
    """The features by which toxic rows stand out most, with a careful estimate of how surely each means toxic.

    The most frequent features of toxic rows are counted over all rows; a feature is chosen by the z-score of its toxic rows.
    """
    frequent = count_features(rows.filter("toxic = 1")).filter("n >= 3").orderBy(F.desc("n"), "feature").limit(candidates).collect()
    if not frequent:
        return []
    toxic = {r["feature"]: r["n"] for r in frequent}
    only = np.sort(np.array(list(toxic), np.int64).view(np.uint64))
    p, chosen = n_toxic / n_rows, []
    for r in count_features(rows, only).collect():
        n, t = r["n"], toxic[r["feature"]]
        z = (t - n * p) / np.sqrt(n * p * (1 - p))
        # lower end of the 95 % interval of the share of toxic rows
        share = (t / n + 1.92 / n - 1.96 * np.sqrt(t / n * (1 - t / n) / n + 0.96 / n**2)) / (1 + 3.84 / n)
        if z >= least_z:
            chosen.append((-z, r["feature"], float(share)))
    return [(f, share) for _, f, share in sorted(chosen)[:most]]


def mark_table(marks: list[tuple[int, float]]) -> dict:
    """Sorted hashes of the marks, their columns and strengths, and a small table at which most other features fall out."""
    hashed = np.array([f for f, _ in marks], np.int64).view(np.uint64)
    order = np.argsort(hashed)
    seen = np.zeros(1 << 16, bool)
    seen[hashed >> np.uint64(48)] = True
    return {"hashes": hashed[order], "columns": order, "shares": np.array([s for _, s in marks], np.float32), "seen": seen}


def marks_of(text: bytes, table: dict) -> tuple[np.ndarray, int, bool, list[float]]:
    """The marks a text has (columns), how many of its words carry one, whether a whole word is one, and ``EXTRA`` numbers.

    These are the log odds of the surest mark, the logarithm of the number of marked words, their share of all words, the share of
    punctuation, and the logarithm of the number of words.
    """
    hashed, word, size = features(text)
    n_words = int((size == 0).sum())
    shape = [3 * float(_MARKS[np.frombuffer(text, np.uint8)].mean()) if text else 0.0, float(np.log1p(n_words)) / 6]
    at = np.flatnonzero(table["seen"][hashed >> np.uint64(48)])
    if len(at):
        place = np.minimum(np.searchsorted(table["hashes"], hashed[at]), len(table["hashes"]) - 1)
        hit = table["hashes"][place] == hashed[at]
        at, place = at[hit], place[hit]
    if not len(at):
        return np.empty(0, np.int64), 0, False, [0.0, 0.0, 0.0, *shape]
    columns, marked = np.unique(table["columns"][place]), len(np.unique(word[at]))
    surest = min(0.995, max(0.05, float(table["shares"][columns].max())))
    return columns, marked, bool((size[at] == 0).any()), [3 + float(np.log(surest / (1 - surest))), float(np.log1p(marked)), min(3.0, 20 * marked / n_words), *shape]


class Inputs:
    """Inputs of the models, row by row: the marks that a text has, by column, then ``plain`` columns of any value.

    A text has few of the marks; as a matrix they would take 2 kB a row on the driver, once more for each fold and copy.
    Columns count as in that matrix: marks first.
    """

    BLOCK = 4096

    def __init__(self, starts: np.ndarray, marks: np.ndarray, n_marks: int, plain: np.ndarray):
        self.starts, self.marks, self.n_marks, self.plain = starts, marks, n_marks, plain

    @classmethod
    def of(cls, x: Inputs | np.ndarray) -> Inputs:
        return x if isinstance(x, cls) else cls(np.zeros(len(x) + 1, np.int64), np.empty(0, np.int32), 0, x)

    def __len__(self) -> int:
        return len(self.plain)

    @property
    def width(self) -> int:
        return self.n_marks + self.plain.shape[1]

    def __getitem__(self, at: tuple[slice, int]) -> np.ndarray:
        """A column, as of a matrix."""
        return self.times(np.eye(1, self.width, at[1] % self.width, dtype=np.float32)[0])[at[0]]

    def extended(self, columns: np.ndarray) -> Inputs:
        return Inputs(self.starts, self.marks, self.n_marks, np.hstack([self.plain, columns]))

    def rows(self, keep: np.ndarray) -> Inputs:
        sizes = np.diff(self.starts)
        return Inputs(np.concatenate([[0], np.cumsum(sizes[keep])]), self.marks[np.repeat(keep, sizes)], self.n_marks, self.plain[keep])

    def _blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for at in range(0, len(self), self.BLOCK):
            starts = self.starts[at : at + self.BLOCK + 1]
            yield slice(at, at + len(starts) - 1), np.repeat(np.arange(len(starts) - 1), np.diff(starts)), self.marks[starts[0] : starts[-1]]

    def times(self, w: np.ndarray) -> np.ndarray:
        """The sum of each row's columns times ``w``."""
        out = self.plain @ w[self.n_marks :]
        for rows, owner, marks in self._blocks():
            out[rows] += np.bincount(owner, w[marks], rows.stop - rows.start)
        return out

    def sums(self, v: np.ndarray) -> np.ndarray:
        """The sum of each column over the rows times ``v``."""
        out = np.zeros(self.n_marks)
        for rows, owner, marks in self._blocks():
            out += np.bincount(marks, v[rows][owner], self.n_marks)
        return np.concatenate([out, v @ self.plain])


def logistic(x: Inputs | np.ndarray, y: np.ndarray, penalty: float = 2e-5, rounds: int = 300) -> np.ndarray:
    """Weights (the intercept last) of an L2-regularised logistic model, by accelerated gradient steps.

    Each weight has a step of its own, from a bound of its curvature: rare marks would hardly move with a common one.
    """
    x = Inputs.of(x).extended(np.ones((len(x), 1), np.float32))
    bound = 0.25 * x.sums(x.times(np.ones(x.width, np.float32))) / len(x)
    step = 1 / (bound + penalty)
    w = ahead = np.zeros(x.width, np.float32)
    for k in range(rounds):
        slope = x.sums(_sigmoid(x.times(ahead)) - y) / len(x)
        slope[:-1] += penalty * ahead[:-1]
        new = (ahead - step * slope).astype(np.float32)
        w, ahead = new, new + np.float32(k / (k + 3)) * (new - w)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _apply(w: np.ndarray, x: Inputs) -> np.ndarray:
    return _sigmoid(x.times(w[:-1]) + w[-1])


def fit_chain(x: Inputs | np.ndarray, targets: list[np.ndarray], fold: np.ndarray, views: dict | None = None) -> list[np.ndarray]:
    """One model per category; the inputs of a later one end with out-of-fold probabilities of the earlier ones.

    ``views`` gives for each fold the inputs and targets as they are without that fold's labels; without it they are ``x`` and ``targets``.
    """
    models, earlier = [], np.empty((len(x), 0), np.float32)
    for k, y in enumerate(targets):
        models.append(logistic(Inputs.of(x).extended(earlier), y))
        out = np.zeros(len(y), np.float32)
        for f in np.unique(fold):
            rest = fold != f
            seen, target = (x, y) if views is None else (views[f][0], views[f][1][k])
            if rest.any():
                inputs = Inputs.of(seen).extended(earlier)
                out[~rest] = _apply(logistic(inputs.rows(rest), target[rest]), inputs.rows(~rest))
            else:
                out[~rest] = y.mean()
        earlier = np.hstack([earlier, out[:, None]])
    return models


def _marked(rows: DataFrame, marks: list[tuple[int, float]]) -> tuple[dict, Inputs, list[np.ndarray], np.ndarray]:
    """The table of the marks; inputs, targets and folds of the sample, in one order for any marks."""
    table = mark_table(marks)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [marks_of(t, table) for t in words.texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "text_hash", "toxic", "poor", "fold")), pa.array([f[0].tolist() for f in found], pa.list_(pa.int32())),
                    *(pa.array([f[i] for f in found], k) for i, k in ((1, pa.int32()), (2, pa.bool_()), (3, pa.list_(pa.float32())))),
                ],
                names=["doc_id", "text_hash", "toxic", "poor", "fold", "has", "n_marked", "whole", "extra"],
            )

    kind = "doc_id long, text_hash long, toxic int, poor int, fold int, has array<int>, n_marked int, whole boolean, extra array<float>"
    marked = rows.select("doc_id", "text_hash", "toxic", "poor", "fold", "text").mapInArrow(mark, kind).toArrow()
    marked = marked.take(np.lexsort((marked["text_hash"].to_numpy(), marked["doc_id"].to_numpy()))).combine_chunks()
    column = lambda name: marked[name].to_numpy().astype(np.float32)
    lists = lambda name: marked[name].combine_chunks()
    has, extra = lists("has"), lists("extra").flatten().to_numpy().reshape(-1, EXTRA)
    x = Inputs(np.concatenate([[0], np.cumsum(has.value_lengths().to_numpy(), dtype=np.int64)]), has.flatten().to_numpy(), len(marks), extra)
    toxic = column("toxic")
    return table, x, [column("poor"), toxic * column("whole"), toxic * (column("n_marked") >= 3), toxic], column("fold").astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, features: int = 512, least_z: float = 4.0, folds: int = 3, seed: int = 5) -> dict | None:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic, and quality if there is one)."""
    poor = F.col("quality") == 0 if "quality" in labels.columns else F.lit(False)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"), F.max(F.when(poor, 1).otherwise(0)).alias("poor")
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    share = min(1.0, sample / max(1, known.count()))
    drawn = F.broadcast(known.filter(draw < share))  # about ``sample`` rows
    rows = stage(
        docs.filter("text is not null").select("doc_id", F.col("text").cast("string")).join(drawn, "doc_id")
        .withColumn("text_hash", F.xxhash64("text")).withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.lit("fold"), "doc_id"), F.lit(folds)).cast("int")),
        "toxicity-sample",
    )
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}

    def marks_without(fold: int | None) -> list[tuple[int, float]]:
        clean, toxic = (sum(n for (f, t), n in sizes.items() if t == kind and f != fold) for kind in (0, 1))
        kept = rows if fold is None else rows.filter(F.col("fold") != fold)
        return choose_marks(kept, clean + toxic, toxic, features, least_z) if clean and toxic else []

    marks = marks_without(None)
    if not marks:
        return None
    table, x, targets, fold = _marked(rows, marks)
    views = {f: _marked(rows, marks_without(f))[1:3] for f in np.unique(fold).tolist()}
    return {"table": table, "models": fit_chain(x, targets, fold, views)}


def _predictor(model: Broadcast, threshold: float):
    kind = pa.struct([*((f"p_{c}", pa.float64()) for c in CATEGORIES), ("toxic", pa.bool_())])

    def predict(texts: pa.Array) -> pa.Array:
        m, out = model.value, []
        for text in words.texts(texts):
            row = dict.fromkeys((f"p_{c}" for c in CATEGORIES), 0.0)
            if m is not None and text:
                has, _, _, extra = marks_of(text, m["table"])
                # after the marks: the extra numbers, the earlier categories, the intercept
                rest = list(extra)
                for c, w in zip(CATEGORIES, m["models"]):
                    p = float(_sigmoid(w[has].sum() + w[len(w) - 1 - len(rest) : -1] @ np.array(rest, np.float32) + w[-1]))
                    rest.append(p)
                    row[f"p_{c}"] = p
            out.append(row | {"toxic": row["p_toxic"] >= threshold})
        return pa.array(out, kind)

    return F.arrow_udf(predict, "struct<" + ", ".join(f"p_{c}: double" for c in CATEGORIES) + ", toxic: boolean>").asNondeterministic()


def score(docs: DataFrame, model: dict | None, threshold: float = 0.5, column: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and one more: the probability of each category, and whether the text is toxic."""
    return docs.withColumn(column, _predictor(docs.sparkSession.sparkContext.broadcast(model), threshold)(F.col("text").cast("string")))
