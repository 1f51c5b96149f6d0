"""From raw documents to sampled token sequences: the stages, each a function of (spark, docs, folder).

Every stage is written as Parquet and read again as the next one's input. The vocabulary of a rejected
document, a dropped line or a removed copy is gone for all later stages.

NULLs, empty and long texts, ties, repeated rows and extra columns are treated as the docstrings of the stages' modules say; an
empty table passes all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityweave.llm import line_dedup, mixing, pieces, rule_ensemble, simhash
from cityweave.llm.rows import table
from cityweave.sources.scratch import durable


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return rule_ensemble.keep_good(docs, rule_ensemble.fit(docs, table(spark, folder, "labels")))


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that are boilerplate of their source go; their documents stay. Equal texts of a source count once."""
    return line_dedup.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents come as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row per document of the mix: its sampled pieces, sizes and a digest."""
    return pieces.digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", tokens),
]

#: SQL cannot fit the rule ensemble, hash shingles with XXH64 or sample segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage over the documents in ``folder``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, folder), name.split()[0].lower())
    return docs
