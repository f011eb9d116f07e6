"""The pipeline's stages: columns, decisions, and the mix over what is left."""

from pyspark.sql import functions as F

import corpus_pipeline
from stayline.llm import decontaminate, langid, minhash, toxicity
from stayline.llm.scratch import stage


def test_stages_keep_columns_and_let_decisions_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", "src1", 0), (90_002, "12 34", None, None, 5)], docs.schema)
    docs, seen = docs.unionByName(odd), {}
    before = {r["doc_id"]: r for r in docs.collect()}
    for i, (name, apply) in enumerate(corpus_pipeline.STAGES):
        out = stage(apply(spark, docs, sf), name)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert all(r == before[r["doc_id"]] for r in out.collect())
        seen[name] = (docs, out)
        docs = out
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    first, kept = seen["language_id"]
    assert ids(first) - ids(kept) == {r["doc_id"] for r in langid.identify(first, langid.fit(first)).filter("language.rejected").collect()} >= {90_001, 90_002}
    given, kept = seen["toxicity"]
    model = toxicity.fit(given, spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids(given) - ids(kept) == ids(toxicity.score(given, model).filter("toxicity.toxic"))
    given, kept = seen["near_dedup"]
    assert ids(kept) == ids(minhash.near_components(given, 5, 80).filter("kept"))
    given, kept = seen["benchmark_leaks"]
    assert ids(given) - ids(kept) == ids(decontaminate.contaminated(given, spark.read.parquet(f"{sf}/benchmark.parquet")))
    given, mixed = seen["mix_sources"]
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert abs(words / (1.5 * sum(len(r["text"].split()) for r in given.collect())) - 1) < 0.1


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, sf)
        assert docs.count() == 0


def test_repeated_and_missing_ids(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "h i j k l m n", "en", "s", 1), (None, "a b c d e f g", "en", None, 1), (None, "x y", None, "s", 1), (2, "a b c d e f g", "en", "s", 1)]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, schema), sf).collect()
    # rows are compared each for its own text, with or without an id
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == [(0, "x y"), (1, "a b c d e f g"), (1, "h i j k l m n")]
    rows = [(1, "a b c d e", "en", "s", 1), (1, "h i j k l", "en", "s", 1), (None, "q r s t u", "en", "s", 1), (None, "q r s t u", "en", "s", 1), (3, "q r s t u", "en", "s", 1),
            (None, "only copies here now", "en", "s", 1), (None, "only copies here now", "en", "s", 1), (4, None, "en", "s", 1), (4, None, "en", "s", 1), (5, "", "en", "s", 1)]
    for parts in (1, 7):
        out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, schema).repartition(parts), sf)
        assert out.columns == schema.names
        assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in out.collect())) == [
            (0, "only copies here now"), (1, "a b c d e"), (1, "h i j k l"), (3, "q r s t u"), (4, ""), (4, ""), (5, "")]


def test_mix_is_the_same_for_any_partitioning(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = [(None if i % 2 else 7, f"text {i} " * (i % 5 + 1), "en", f"s{i % 3}", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, schema)
    once = lambda n: sorted((r["doc_id"] or 0, r["text"], r["mix_copy"]) for r in corpus_pipeline.mix_sources(spark, docs.repartition(n), sf).collect())
    assert once(2) == once(5) and len({r[1] for r in once(2)}) > 300


def test_rows_without_an_id_stay_spread(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = [(i if i % 3 else None, f"text number {i} of many", "en", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, schema).repartition(8)
    out = corpus_pipeline.near_dedup(spark, docs, sf).withColumn("part", F.spark_partition_id()).filter("doc_id is null")
    per_part = [r["count"] for r in out.groupBy("part").count().collect()]
    assert sum(per_part) == 200 and max(per_part) < 100
