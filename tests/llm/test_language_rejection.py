"""Texts in no learned language are rejected, and clean ones stay."""

from __future__ import annotations

import random
import string

from pyspark.sql import functions as F

from seismark.llm import language

SF = "/root/testdata/sf0.01"
UNLEARNED = (
    "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
    "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
)


def test_junk_and_unlearned_languages_go(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(2, 9)))
    junk = [" ".join(word() for _ in range(n)) for n in (20, 50, 200, 1000) for _ in range(5)]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    planted = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate([*junk, *UNLEARNED])], documents.schema)
    kept = language.keep_identified(documents.unionByName(planted)).select("doc_id").collect()
    clean = documents.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in clean)


def test_a_language_left_out_of_the_labels_goes(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") >= 200)
    for lang in ("de", "fr"):
        unlabelled = documents.withColumn("lang", F.when(F.col("lang") != lang, F.col("lang")))
        kept = {r["doc_id"] for r in language.keep_identified(unlabelled).select("doc_id").collect()}
        own = {r["doc_id"] for r in documents.where(F.col("lang") == lang).collect()}
        other = {r["doc_id"] for r in documents.where(F.col("lang") != lang).collect()}
        print(lang, len(own & kept), len(own), len(other - kept))
        assert len(own & kept) <= 0.1 * len(own) and other <= kept
