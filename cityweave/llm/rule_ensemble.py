"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of the whole text are Spark columns. A random forest of shallow trees is fitted on them; every path from
a root to a node is a conjunctive rule; a lasso logistic regression on the rules keeps few of them; these are
compiled into one Spark column expression, so scoring is a scan without Python.

The fit uses at most ``SAMPLE`` labelled documents, picked by a hash of their ids: that bounds what the driver and
the one training task hold. Everything else sees all documents.

Defined results: NULL text is scored as an empty one; labels that are NULL, belong to no document or contradict
each other (repeated ids: the smallest label and statistics count) are settled before the fit; without
labels of both kinds the score is the share of label 1 (0.5 without any); repeated documents are scored one by one;
extra columns of the documents play no part. Statistics are of whole texts of any length. Candidates for the sample with equal hashes
go by doc_id; a score equal to ``KEEP_FROM`` counts as good. An empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.rows import as_row
from cityweave.llm.trees import Condition, rules

SAMPLE = 20_000
FOLDS = 5
KEEP_FROM = 0.3
TREES = 24
DEPTH = 3
LASSO = 0.0005
SEED = 11
SYMBOLS = "#*$%&|<>"
SPACES = r"[\x20\x09-\x0D]+"


class Model(NamedTuple):
    rules: list[tuple[Condition, ...]]
    weights: list[float]
    intercept: float


def fold(doc_id: Column) -> Column:
    """Remainder of the CRC-32 of the id as text; 0 (never learned from) for NULL."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0)).cast("int")


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """Adds array column ``stats``; its entries are the features of the trees."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # What is left without lower-case letters and spaces is short in prose, and all shares below are taken from it.
    rest = F.regexp_replace(whole, "[a-zß-öø-ÿ ]+", "")
    df = df.withColumns({"_n_chars": F.length(whole), "_rest": rest, "_words": F.split(whole, SPACES)})
    words, n_words = F.col("_words"), F.greatest(F.size("_words"), F.lit(1))
    n_chars = F.greatest(F.col("_n_chars"), F.lit(1))

    def share(characters: str) -> Column:
        return F.length(F.regexp_replace("_rest", f"[^{characters}]+", "")) / n_chars

    stats = [
        F.log1p(n_words),
        n_chars / n_words,
        share(SYMBOLS),
        share("!?"),
        share("|"),
        share(".,;:"),
        share("0-9"),
        share(r"\n"),
        share(r"\p{Lu}"),
        F.size(F.array_distinct(words)) / n_words,
    ]
    return df.withColumn("stats", F.array(*[s.cast("double") for s in stats])).drop("_n_chars", "_rest", "_words")


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, label, stats of at most ``sample`` documents outside fold 0."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label in (0, 1)")
    learn = (
        known.where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers: a proven size.
    texts = docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id")
    return with_statistics(texts, "text").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("stats").alias("stats"))


def holds(rule: tuple[Condition, ...]) -> Column:
    whole = F.lit(True)
    for feature, above, threshold in rule:
        value = F.col("stats")[feature]
        whole = whole & (value > threshold if above else value <= threshold)
    return whole


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    rows = sorted((r.doc_id, r.label, list(r.stats)) for r in labelled_statistics(docs, labels, sample).collect())
    positive = sum(label for _, label, _ in rows)
    if not 0 < positive < len(rows):
        share = min(max(positive / len(rows), 1e-6), 1 - 1e-6) if rows else 0.5
        return Model([], [], math.log(share / (1 - share)))
    # One partition and a fixed order: the same sample gives the same trees on any cluster.
    data = spark.createDataFrame(rows, "doc_id long, label double, stats array<double>").coalesce(1)
    forest = RandomForestClassifier(
        featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5", minInstancesPerNode=5
    ).fit(data.select("label", array_to_vector("stats").alias("features")))
    found = rules(forest.trees)
    if not found:
        return Model([], [], math.log(positive / (len(rows) - positive)))
    met = data.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in found])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=100).fit(met)
    kept = [(r, float(w)) for r, w in zip(found, lasso.coefficients.toArray()) if abs(w) > 1e-9]
    return Model([r for r, _ in kept], [w for _, w in kept], float(lasso.intercept))


def score_of(model: Model) -> Column:
    """The ensemble as a column over ``stats``."""
    total = F.lit(model.intercept)
    for rule, weight in zip(model.rules, model.weights):
        total = total + F.when(holds(rule), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = with_statistics(docs.select("doc_id", "text"), "text").withColumn("score", score_of(model))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model predicts to be good.

    A filter would be pushed below the statistics and compute them anew for every condition of every rule. Exploding
    an array of one entry or none keeps them computed once.
    """
    rows = docs.select(as_row(docs).alias("row"), F.col("text").alias("text"))
    good = F.when(score_of(model) >= KEEP_FROM, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return with_statistics(rows, "text").select("row", F.explode(good)).select("row.*")
