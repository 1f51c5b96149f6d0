"""Exact dedup by progressive refinement: length, then a hash of the beginning, then a hash of the whole text.

Each stage looks only at what the one before left in groups of two or more: lengths are counted for all rows, the hash
of the first ``HEAD`` characters is taken where a length occurs again, and the whole text is hashed only where length
and beginning occur again. Every stage is one scan and a count with partial sums in each task; what it leaves is written, so
texts are never shuffled. The tables that say what is left are broadcast only after their rows were counted; above
``MOST_BROADCAST`` a stage is skipped and its rows all go to the next one, which gives the same groups.

The joins back to the rows split groups with a large part of all rows.

Defined results: a NULL text counts as empty; the largest key of a group stays, a NULL key only where a group has no other; of
rows with equal text and key exactly one stays, whichever other columns they have; repeated rows are rows; long texts are hashed
whole; an empty table gives no rows; extra columns, whatever their names, are kept in ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.operators.skew import join_per_key
from cityweave.sources.scratch import durable

HEAD = 256
MOST_BROADCAST = 1_000_000


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _repeated(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The values of ``keys`` that occur in two rows or more."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return durable(counted.select(*keys), label)


def _only(rows: DataFrame, left: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``rows`` with ``again``: whether the stage that gave ``left`` left them in a group. All of them if it is too long."""
    n = left.limit(most + 1).count()
    if n > most:
        return rows
    marked = rows.join(F.broadcast(left.withColumn("found", F.lit(True))), keys, "left")
    return marked.withColumn("again", F.col("again") & F.col("found").isNotNull()).drop("found")


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] | None = None,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """One row per input row: ``row`` (its columns, or those in ``carry``), ``keep_id``, ``group_size``, ``kept``."""
    columns = docs.columns if carry is None else carry
    whole = whole_text(F.col(f"`{text}`"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{key}`").alias("key"),
        whole.alias("whole"),
        F.octet_length(whole).alias("size"),
        F.lit(True).alias("again"),
    )
    rows = _only(rows, _repeated(rows, ["size"], "sizes"), ["size"], most_broadcast)
    rows = rows.withColumn("head", F.when(F.col("again"), F.xxhash64(F.substring("whole", 1, HEAD))))
    rows = _only(rows, _repeated(rows.where("again"), ["size", "head"], "heads"), ["size", "head"], most_broadcast)
    rows = rows.withColumn("full", F.when(F.col("again"), F.unhex(F.sha2("whole", 256))))
    groups = durable(_groups(rows.where("again")), "copies")
    found = join_per_key(rows.drop("whole", "again", "head"), groups, ["size", "full"], "group_size")
    grouped = F.col("in_group").isNotNull()
    found = found.select(
        "row",
        "size",
        "full",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("key")).alias("keep_id"),
        F.when(grouped, F.col("n_rows")).otherwise(1).cast("long").alias("group_size"),
        (~grouped | F.col("key").eqNullSafe(F.col("keep_id"))).alias("kept"),
    )
    if groups.where("n_largest > 1").limit(1).count():
        found = _one_of_equal_keys(found)
    return found.select("row", "keep_id", "group_size", "kept")


def _groups(rows: DataFrame) -> DataFrame:
    """Per group: its size, its largest key and how many rows have that key."""
    by_key = rows.groupBy("size", "full", "key").agg(F.count("*").alias("n"))
    largest = F.max(F.struct(F.col("key").isNotNull(), F.col("key").alias("key"), F.col("n").alias("n"))).alias("largest")
    groups = by_key.groupBy("size", "full").agg(F.sum("n").alias("group_size"), largest).where("group_size > 1")
    return groups.select(
        "size",
        "full",
        "group_size",
        F.col("group_size").alias("n_rows"),
        F.col("largest.key").alias("keep_id"),
        F.col("largest.n").alias("n_largest"),
        F.lit(True).alias("in_group"),
    )


def _one_of_equal_keys(found: DataFrame) -> DataFrame:
    """Where several rows of a group have its largest key, leave ``kept`` to one: first per partition, then over all."""
    place = found.withColumn("place", F.spark_partition_id())
    near = Window.partitionBy("size", "full", "kept", "place").orderBy(F.xxhash64("row"))
    single = F.col("full").isNull()
    place = place.withColumn("first", F.col("kept") & (single | (F.row_number().over(near) == 1)))
    far = Window.partitionBy("size", "full", "first", F.when(F.col("first") & ~single, -1).otherwise(F.col("place")))
    return place.withColumn("kept", F.col("first") & (single | (F.row_number().over(far.orderBy(F.xxhash64("row"))) == 1)))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return judge(docs, key, text).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
