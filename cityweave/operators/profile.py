"""Counts, rankings, summaries and samples of one table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.numbers import is_number
from cityweave.operators.quantiles import FEW_VALUES, with_rows

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
HASH_PARTS = 65_536


def counts_by(df: DataFrame, *columns: str, count: str = "n") -> DataFrame:
    """Rows per combination of present values."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias(count))


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Values of a column by falling frequency, equal ones by value; NULL is not a value."""
    return counts_by(df, column, count=count).orderBy(F.desc(count), column)


def frequent_values(df: DataFrame, column: str, at_least: int | Column, count: str = "n") -> DataFrame:
    """Values that occur at least so often."""
    return counts_by(df, column, count=count).where(F.col(count) >= at_least).orderBy(F.desc(count), column)


def top_values(df: DataFrame, column: str, k: int, count: str = "n") -> DataFrame:
    """The ``k`` most frequent values."""
    return value_counts(df, column, count).limit(k)


def ranking(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their rank from 1; ``k`` rows, so one task may number them."""
    order = Window.orderBy(F.desc("n"), column)
    return top_values(df, column, k).select(column, F.row_number().over(order).alias("rank"))


def in_order_of(df: DataFrame, ranked: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose value is listed in ``ranked`` (a :func:`ranking`), in its order."""
    return df.join(F.broadcast(ranked), column).orderBy("rank")


def keep_top_values(df: DataFrame, column: str, k: int, ranked_in: DataFrame | None = None) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent ones of ``ranked_in`` (``df`` itself by default).

    The list has ``k`` rows, so it is broadcast.
    """
    top = top_values(df if ranked_in is None else ranked_in, column, k).select(column)
    return df.join(F.broadcast(top), column, "left_semi").select(*df.columns)


def nlargest(df: DataFrame, column: str, k: int, key: str) -> DataFrame:
    """The ``k`` rows with the largest value, equal ones by ``key``; rows without a value never count."""
    return df.where(F.col(column).isNotNull()).orderBy(F.desc(column), key).limit(k)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A repeatable sample of exactly ``n`` rows, or all rows if there are fewer.

    Rows are taken by rising hash of seed and key, so the choice does not depend on partitions. A count per
    hash part first finds the part in which row ``n`` lies; only rows up to there enter the final sort,
    which therefore sees little more than ``n`` rows however large the table is.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    part = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    sizes = df.select(part.alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # At most HASH_PARTS rows, so one task may order them.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    last = sizes.select("part", before.alias("before")).where(F.col("before") < n).agg(F.max("part")).scalar()
    return df.where(part <= last).orderBy(digest, key).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """Number of NULLs per column, in one pass, as (position, column_name, n_null)."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, column: str, few: int = FEW_VALUES) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the numbers in a column."""
    v = F.col("v")
    moments = [
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    found = with_rows(df, column, QUARTILES, [], None, few, moments)
    return found.select(F.col("rows").alias("n"), "mean", "std", "min", *QUARTILES, "max")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both are present."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    name = {pair: f"c{i}" for i, pair in enumerate(pairs)}
    own = [F.var_pop(F.col(c).cast("double")).alias(f"v_{c}") for c in columns]
    found = df.agg(
        *own, *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name[a, b]) for a, b in pairs]
    )

    def entry(a: str, b: str):
        if a == b:
            value = F.when(F.col(f"v_{a}") > 0, 1.0)
        else:
            value = F.col(name[(a, b) if (a, b) in name else (b, a)])
        return F.struct(F.lit(a).alias("row_variable"), F.lit(b).alias("column_variable"), value.alias("correlation"))

    return found.select(F.inline(F.array(*[entry(a, b) for a, b in product(columns, columns)])))
