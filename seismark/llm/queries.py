"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismark.llm import (
    decontamination, divergence, language, licenses, lines, lm_score, oracle, packing, passages, ranked, simhash, substring,
    topk, toxicity,
)
from seismark.llm._ship import ship_package
from seismark.workload.registry import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return register


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query(oracle.TOP_K)
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query(oracle.DECONTAMINATION)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query()
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


@query(oracle.PASSAGES)
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_passages(table(spark, sf_dir, "documents"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracle.RANKED)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(oracle.DIVERGENCE)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query()
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))
