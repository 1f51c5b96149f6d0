"""Joins that stay balanced when one key, or NULL, holds a large part of the rows or of the work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.sources.scratch import durable

MAX_HOT_KEYS = 10_000
ROWS_PER_PART = 1_000_000
NULL_PARTS = 4096


def join_per_key(
    rows: DataFrame, per_key: DataFrame, keys: list[str], n_rows: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Left-join ``rows`` to ``per_key``, which has one row per key and in ``n_rows`` the rows of that key.

    Keys above the limit are split into parts: their ``per_key`` row is repeated once per part and each of
    their rows goes to one part. The limit is at least a ten-thousandth of all rows, so fewer than
    ``MAX_HOT_KEYS`` keys can be above it; that proves the size of the list that is broadcast. Rows with a
    NULL key match nothing and are spread out.

    Parts are chosen from the row's values and its input partition, both the same when a task is repeated,
    and exact copies still spread because they come from different partitions.
    """
    total = per_key.agg(F.sum(n_rows)).scalar()
    limit = F.greatest(total / MAX_HOT_KEYS, F.lit(float(rows_per_part)))
    parts = F.ceil(F.col(n_rows) / limit).cast("int")
    sized = per_key.withColumn("_parts", F.when(F.col(n_rows) > limit, parts).otherwise(1))
    hot = sized.where(F.col("_parts") > 1).select(*keys, "_parts")
    repeated = sized.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts", n_rows)

    spread = F.xxhash64(*rows.columns) + F.spark_partition_id()
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    part = (
        F.when(no_key, -1 - F.pmod(spread, F.lit(NULL_PARTS)))
        .when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts")))
        .otherwise(0)
        .cast("int")
    )
    routed = rows.join(F.broadcast(hot), keys, "left").withColumn("_part", part).drop("_parts")
    return routed.join(repeated, [*keys, "_part"], "left").drop("_part")


# Pieces of work per task, so that tasks differ little, and pairs of rows below which a key is never split.
PIECES_PER_TASK = 32
LEAST_WORK = 10_000
# Rows of a side up to which it is broadcast; keys and numbers, so some ten MB.
FEW_ROWS = 200_000


def join_by_work(
    left: DataFrame, right: DataFrame, keys: list[str], few_rows: int = FEW_ROWS, least_work: int = LEAST_WORK
) -> DataFrame:
    """Inner join of written tables in tasks of about equal work, where a key costs the product of its rows.

    A short ``right`` is broadcast, and the rows of ``left`` stay where they are. Otherwise the cost of every key is counted.
    A key above one piece of the work is split into its number of pieces: ``left`` is dealt over them, and ``right`` is
    repeated, or split too where it has more rows, so that each pair of rows meets in one piece. Fewer keys than there
    are pieces can be above one piece, which bounds the list that is broadcast.
    """
    spark = left.sparkSession
    if right.limit(few_rows + 1).count() <= few_rows:
        return left.join(F.broadcast(right), keys)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_left"))
    counts = counts.join(right.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_right")), keys)
    counts = durable(counts.withColumn("_work", F.col("_left") * F.col("_right")), "join-work")
    total = counts.agg(F.sum("_work")).first()[0] or 0.0
    piece = max(total / (PIECES_PER_TASK * tasks), float(least_work))
    pieces, ratio = F.ceil(F.col("_work") / piece), F.sqrt(F.col("_left") / F.col("_right"))
    left_parts = F.least(F.greatest(F.ceil(F.sqrt(pieces) * ratio), F.lit(1)), pieces).cast("int")
    split = counts.where(F.col("_work") > piece).select(
        *keys, left_parts.alias("_left_parts"), F.ceil(pieces / left_parts).cast("int").alias("_right_parts")
    )

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        met = rows.join(F.broadcast(split), keys, "left")
        at = F.pmod(F.xxhash64(*rows.columns), F.coalesce(F.col(f"{own}_parts"), F.lit(1)).cast("long")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"{other}_parts"), F.lit(1)) - 1))
        met = met.withColumns({f"{own}_part": at}).withColumn(f"{other}_part", every).drop("_left_parts", "_right_parts")
        return met.repartition(tasks, *keys, "_left_part", "_right_part")

    parts = ["_left_part", "_right_part"]
    return dealt(left, "_left", "_right").join(dealt(right, "_right", "_left"), [*keys, *parts]).drop(*parts)
