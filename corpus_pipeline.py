"""A corpus pipeline over ``documents``: language, toxicity, near copies, benchmark leaks, and a mix to target weights.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and lets its decisions take effect. All but the
last return the columns of ``documents``; the last has one row for each time that the mix emits a document.

Columns of the input that the stages don't know pass through; names that start with ``llm_`` or ``mix_`` are reserved. Texts that are null or have no letter go at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayline.llm import decontaminate, langid, minhash, mixing, toxicity
from stayline.llm.scratch import stage
from stayline.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are too far from every language learned from the labelled ones."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    return langid.identify(docs, model, "llm_language").filter("not llm_language.rejected").select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose chain ends in toxic."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, column="llm_toxicity").filter("not llm_toxicity.toxic").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, similarity of 0.8 or more), the one with the smallest id.

    Every row is compared for its own text, also rows without an id and rows that repeat one.
    """
    return minhash.one_of_each(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), column="llm_hits")
    return found.filter("size(llm_hits) = 0").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each time the mix emits a document."""
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("benchmark_leaks", benchmark_leaks),
    ("mix_sources", mix_sources),
]
# classifiers and near copies are beyond SQL; tests/llm tests the operators against plain versions and the stages' decisions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
