"""The pipeline's stages on a whole small table: what each keeps, and the result of them all."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from seismark.llm import decontamination, language, lines, simhash
from seismark.llm._spark import written

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
        assert len(kept[-1]) == docs.count()
    source = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"] for r in language.identify(source).where("lang_pred <> 'und'").collect()}
    assert set(kept[0]) == found
    first = spark.createDataFrame([(i, t) for i, t in kept[0].items()], "doc_id long, text string")
    report = {r["doc_id"]: r["n_removed"] for r in lines.line_report(first).collect()}
    for i, text in kept[0].items():
        if i in kept[1]:
            assert len(text.split("\n")) - len(kept[1][i].split("\n")) == report[i]
        else:
            assert report[i]
    second = spark.createDataFrame([(i, t) for i, t in kept[1].items()], "doc_id long, text string")
    assert set(kept[2]) == {r["component_id"] for r in simhash.simhash_groups(second).collect()}
    third = spark.createDataFrame([(i, t) for i, t in kept[2].items()], "doc_id long, text string")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = decontamination.contamination(spark, third, benchmark).where("NOT contaminated")
    assert set(kept[3]) == {r["doc_id"] for r in clean.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    want = Counter(map(tuple, packed.select(*columns).collect()))
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select(*columns).collect())) == want


def test_columns_named_like_those_of_the_operators_stay(spark):
    """A column of a user passes every stage, whatever its name."""
    from pyspark.sql import functions as F

    names = ["score", "lang_pred", "words", "items", "n_words", "_text", "_row", "_id", "_gone", "_hash", "_whole", "text_hash", "component", "a.b", "_a"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, SF), "test-clash")
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        for r in kept.collect():
            assert all(r[n] == f"{n}-{r['doc_id']}" for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).count() > 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).collect() == []
