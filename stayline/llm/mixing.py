"""Mixing sources to target weights by systematic sampling.

Each document is expected ``target / source size`` times. The expected copies of a source's documents are summed one
after the other, a random offset is added, and a document is emitted once for each whole number that the sum crosses at
it. Sums are whole numbers of ``1 / UNIT`` copies, so that they don't depend on the order in which tasks add.

Documents of a source stand in the order of their size, then of a hash of their id: neighbours weigh alike, so the words
taken stay within about one document of the target. The running sum is built in two levels: inside cells of a source
(a size range and a hash bucket), and over the sums of the cells. No task sees a whole source.

Nulls: a null text has size 0; the null source is a source of its own, the last one. Documents of size 0 are sampled like
others and add no words; a source of size 0 has target 0 and emits nothing. Repeated rows are documents of their own. A null id
draws by its text; rows of equal ids stand in the order of a hash of their text.
Empty tables give no rows. All other columns are kept; names that start with ``mix_`` are reserved, and such columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.scratch import stage

UNIT = 1 << 20
SPACE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null. Every word becomes one letter, white space goes."""
    return F.coalesce(
        F.length(F.translate(F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", "x"), SPACE, "")).cast("long"), F.lit(0).cast("long")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``mix_key, source_size`` to the same with ``target``; the key is ``=source``, empty for the null source.

    Sources in code-point order (null last) take the weights in turn and share ``share`` times all sizes. No target is
    above ``most`` times its source's size; what is above goes to the others by weight until none is. This is one level
    L with target = min(weight * L, cap) that sums to the whole: with sources in the order of cap / weight, the sources
    before the level are full. One row per source enters the two ordered windows, never a row per document.
    """
    order = Window.orderBy(F.col("mix_key") == "", F.col("mix_key").cast("binary"))
    before = Window.orderBy("mix_ratio", "mix_rank").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("mix_rank", F.row_number().over(order))
        .withColumn("mix_weight", F.element_at(turns, (F.pmod(F.col("mix_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("mix_cap", F.col("source_size") * F.lit(most))
        .withColumn("mix_ratio", F.col("mix_cap") / F.col("mix_weight"))
        .withColumn("mix_left", F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("mix_cap").over(before), F.lit(0.0)))
        .withColumn("mix_open", F.sum("mix_weight").over(everything) - F.coalesce(F.sum("mix_weight").over(before), F.lit(0.0)))
        # with every source before this one full, the level would be this; the first that it doesn't fill sets it
        .withColumn("mix_level", F.col("mix_left") / F.col("mix_open"))
    )
    first = F.min(F.when(F.col("mix_level") <= F.col("mix_ratio"), F.struct("mix_ratio", "mix_level"))).over(everything)
    return ranked.withColumn("mix_at", first).select(
        "mix_key", "source_size",
        F.coalesce(F.least(F.col("mix_cap"), F.col("mix_weight") * F.col("mix_at.mix_level")), F.col("mix_cap")).alias("target"),
    )


def _draw(*parts: Column | int | str) -> Column:
    """60 bits of a hash that other engines can compute as well."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(
    docs: DataFrame, seed: int = 7, cells: int = 64, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
    size: Column | None = None,
) -> DataFrame:
    """All documents with ``mix_size, mix_source_size, mix_target, mix_copies`` (how often the mix emits them).

    ``docs`` needs ``doc_id`` and ``source``, and ``text`` unless a size is given; all its columns are kept.
    ``cells`` is the number of hash buckets in which documents of like size are split.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    sized = docs.withColumn("mix_size", n_words(F.col("text")) if size is None else size)
    # a quarter of an octave of size, then a bucket of the id: the cells of a source in their order
    bits = F.length(F.bin("mix_size"))
    quarter = F.floor(F.col("mix_size") * 8 / F.pow(F.lit(2.0), bits)).cast("long")
    # rows without an id draw by their text, and text orders rows of equal ids, so that any partitioning gives the same copies
    text = F.coalesce(F.col("text").cast("string"), F.lit("")) if "text" in docs.columns else F.lit("")
    placed = (
        sized.withColumn("mix_draw", _draw(seed, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(text.cast("binary"))))))
        .withColumn("mix_text", F.xxhash64(text))
        .withColumn("mix_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .withColumn("mix_cell", (bits.cast("long") * 8 + quarter) * cells + F.pmod(F.col("mix_draw"), F.lit(cells)))
    )
    # read twice below: written once, so that the texts are not counted again
    per_cell = stage(placed.groupBy("mix_key", "mix_cell").agg(F.count(F.lit(1)).alias("mix_n"), F.sum("mix_size").alias("mix_words")), "mix-cells")
    per_source = targets(per_cell.groupBy("mix_key").agg(F.sum("mix_words").alias("source_size")), weights, share, most).select(
        "mix_key", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long").alias("mix_rate"),
        F.pmod(_draw(seed, "offset", F.col("mix_key")), F.lit(UNIT)).alias("mix_offset"),
    )
    run = Window.partitionBy("mix_key").orderBy("mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.select("mix_key", "mix_cell", F.coalesce(F.sum("mix_n").over(run), F.lit(0)).alias("mix_before")).join(per_source, "mix_key")
    inside = Window.partitionBy("mix_key", "mix_cell").orderBy("mix_size", "mix_draw", "doc_id", "mix_text")
    crossed = lambda n: F.shiftright(n * F.col("mix_rate") + F.col("mix_offset"), UNIT.bit_length() - 1)
    place = F.col("mix_before") + F.col("mix_nth")
    return (
        placed.withColumn("mix_nth", F.row_number().over(inside))
        .join(starts, ["mix_key", "mix_cell"])
        .withColumn("mix_copies", (crossed(place) - crossed(place - 1)).cast("long"))
        .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per emitted copy, numbered from 1 in ``mix_copy``; documents that the mix leaves out are gone."""
    return mixed.filter("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).drop("mix_copies")
