"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cityweave.llm import (
    compression,
    conversation,
    exact_dedup,
    line_dedup,
    mixing,
    pieces,
    pii,
    rule_ensemble,
    simhash,
    spelling,
    topk,
    url_filter,
    warc,
)
from cityweave.llm.oracles import LLM_ORACLES
from cityweave.llm.rows import table

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.plan_mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.col("kept").alias("text"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return rule_ensemble.score(docs, rule_ensemble.fit(docs, table(spark, folder, "labels")))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.with_component_ids(table(spark, folder, "documents"))


def op8_compression(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return compression.judge(docs, compression.fit_bands(docs, table(spark, folder, "labels")))


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op11_conversation(spark: SparkSession, folder: str) -> DataFrame:
    return conversation.repair(table(spark, folder, "conversations"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(exact_dedup.whole_text(F.col("text")), 256))
    found = exact_dedup.judge(docs, carry=["doc_id", "text_sha256"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")


LLM_QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_mixing": op2_mixing,
    "op3_topk": op3_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_compression": op8_compression,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_pii": op10_pii,
    "op11_conversation": op11_conversation,
    "op12_spelling": op12_spelling,
    "op13_exact_dedup": op13_exact_dedup,
    "pipeline": corpus_pipeline.run,
}
