"""One registered query per operator, over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from inkwell.llm import (conversation_repair, decontaminate, language_id, licence_scan, lm_score, merkle, mixing, neighbours, packing, pii, quality, simhash,
                         spotsigs, url_filter)
from inkwell.llm.common import table
from inkwell.llm.settings import OTHER_WEIGHT, SIMHASH_BITS, SIMHASH_WORDS, TARGET_WEIGHTS, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


@register("op1_licence_scan", licence_scan.oracle())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.licence_scan(table(spark, sf_dir, "documents"))


@register("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@register("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register("op2_spotsigs")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        neighbours.order_key(F.col("doc_id"), text).alias("key"), "doc_id", text.alias("text"))
    rows = neighbours.with_next(docs, {"own": spotsigs.signatures(F.col("text"))}, ["text", "own"])
    rows = rows.withColumn("edited", spotsigs.with_tail_of(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("changed", spotsigs.signatures(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.as_text(F.col("own")).alias("fingerprint"), spotsigs.as_text(F.col("changed")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        spotsigs.likeness(F.col("own"), F.col("next_own")).alias("near_next"))


@register("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [k.name for k in pii.BASE]
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in kinds],
        F.sha2(pii.as_text(*kinds).cast("binary"), 256).alias("base_sha256"), pii.as_text(*kinds, "added").alias("spans"))


@register("op7_mixing", mixing.oracle(TARGET_WEIGHTS, OTHER_WEIGHT))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), TARGET_WEIGHTS, OTHER_WEIGHT)


@register("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@register("op10_lm_score")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = lm_score.counted(docs)
    return lm_score.score(docs, lm_score.train(docs, counts), counts)


@register("op11_conversation_repair", conversation_repair.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


@register("op12_merkle", merkle.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(merkle.build(merkle.document_leaves(table(spark, sf_dir, "documents")), ["doc_id"]))


@register("op13_decontaminate", decontaminate.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join("items", ",").cast("binary")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
