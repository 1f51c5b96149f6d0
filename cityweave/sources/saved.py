"""Changes to saved tables: columns added in the catalog, updates of the partitions they touch, versions swapped whole.

Everything goes through Spark's catalog and writers. Names are those of tables in the current database.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cityweave.sources.resume import Files
from cityweave.sources.scratch import durable
from cityweave.sources.tables import update_columns


def add_column(spark: SparkSession, table: str, name: str, type_: str, default: str | None = None) -> DataFrame:
    """Add a column to a saved table unless it has one of that name, in any letter case. No file is read or written.

    ``default`` is a SQL literal; rows written before have it, too.
    """
    if name.lower() not in (c.lower() for c in spark.table(table).columns):
        spark.sql(f"alter table {table} add columns ({name} {type_}{f' default {default}' if default else ''})")
    return spark.table(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def update(spark: SparkSession, table: str, assignments: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Replace columns by expressions on the rows of a saved table that satisfy ``where``.

    Only the partitions with such rows are rewritten; the files of all others stay. Their new rows are written beside the
    table first, as it cannot be read and overwritten at once. A table without partitions is rewritten. Partition columns
    cannot be assigned to.
    """
    partitions, rows = partition_columns(spark, table), spark.table(table)
    if set(partitions) & set(assignments):
        raise ValueError("a partition column cannot be updated")
    touched = rows
    if partitions and where is not None:
        found = durable(rows.where(where).select(*partitions).distinct(), "touched")
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in partitions]
        touched = rows.alias("r").join(found.alias("t"), same, "left_semi")
    changed = durable(update_columns(touched, assignments, where).select(*rows.columns), "updated")
    if changed.limit(1).count():
        if partitions:
            # Only partitions that exist are written, so the catalog knows them all.
            about = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table}").collect()}
            writer = changed.repartition(*partitions).write.format(about["Provider"]).partitionBy(*partitions)
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(about["Location"])
        else:
            changed.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that readers of ``name`` see."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"show tblproperties {name}").where("key = 'version'").collect()
    return found[0].value if found else None


def publish(df: DataFrame, name: str, version: str, rows: int | None = None, folder: str | None = None) -> DataFrame:
    """Make ``df`` the content of ``name``, a view of the newest version; idempotent by ``version``.

    The rows are saved as a table of their own and counted while they are written. If there are ``rows`` of them, the view
    is replaced, one step in the catalog. Until then readers see the earlier version, and after a failure they go on
    to. The version before the newest is kept for readers that have begun; older ones are dropped. Versions lie in the
    warehouse, or below ``folder``.
    """
    spark = df.sparkSession

    def drop(table: str) -> None:
        spark.sql(f"drop table if exists {table}")
        if folder:
            Files(spark).delete(f"{folder}/{table}")

    if current_version(spark, name) == version:
        return spark.table(name)
    staged, seen = f"{name}__{version}", Observation()
    drop(staged)
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    (writer.option("path", f"{folder}/{staged}") if folder else writer).saveAsTable(staged)
    if rows is not None and seen.get["n"] != rows:
        drop(staged)
        raise RuntimeError(f"{name} version {version} has {seen.get['n']} rows, not {rows}; the earlier version stays")
    before = current_version(spark, name)
    spark.sql(f"create or replace view {name} tblproperties ('version' = '{version}') as select * from {staged}")
    keep = {staged.lower(), f"{name}__{before}".lower()}
    for table in spark.catalog.listTables(pattern=f"{name}__*"):
        if table.name.lower() not in keep:
            drop(table.name)
    return spark.table(name)
