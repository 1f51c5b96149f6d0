"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what goes to a Python worker at once by bytes, as texts may be long. A setting made by the user stays."""
    if spark.conf.get(BATCH_BYTES, None) in (None, "-1", "268435456b", "268435456", str(2**31 - 1)):
        spark.conf.set(BATCH_BYTES, size)


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. Each word shrinks to one letter, so no array of words is built."""
    marks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(marks) - F.length(F.replace(marks, F.lit("x"), F.lit(""))), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def text_key(text: Column) -> Column:
    """A hash that tells rows of one id with different texts apart."""
    return F.xxhash64(text)


def as_row(df: DataFrame) -> Column:
    """The whole input row in one column, so that no column of it can clash with a name used here."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
