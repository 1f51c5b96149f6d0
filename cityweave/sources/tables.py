"""Sinks, saved tables and small looks at a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, headers: Mapping[str, str] | None = None, compression: str = "none") -> None:
    """Overwrite ``path`` with CSV part files that carry a header line."""
    if headers:
        df = df.withColumnsRenamed(dict(headers))
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path, compression=compression)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with Parquet, optionally one folder per value of ``partition_by``.

    Rows of one folder are brought together first, so it does not get a file from every task; adaptive execution
    splits large folders between tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def create_table_if_absent(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Save ``df`` as ``table`` unless it exists; returns the table either way."""
    writer = df.write.mode("ignore")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Save ``df`` as ``table``, replacing what was there."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def expose(df: DataFrame, name: str) -> None:
    """Make ``df`` visible to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)


def add_column_if_missing(df: DataFrame, name: str, type_: str, default=None) -> DataFrame:
    """Add a column with a default unless one of that name exists, in any letter case."""
    if name.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(name, F.lit(default).cast(type_))


def update_columns(df: DataFrame, assignments: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Replace columns by expressions, on the rows that satisfy ``where`` if it is given."""
    if where is not None:
        assignments = {c: F.when(where, e).otherwise(F.col(c)) for c, e in assignments.items()}
    return df.withColumns(dict(assignments))


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: position, name and type."""
    rows = [(i, name, type_) for i, (name, type_) in enumerate(df.dtypes, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def preview(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    return df.orderBy(*([key] if isinstance(key, str) else key)).limit(n)
