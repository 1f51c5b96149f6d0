"""One table that serves the dashboard: counts by month, type and descent, and their sums, refreshed month by month.

The table holds a row per cell of four groupings, told apart by ``level``. Counts add, so shares over all months are sums over
its few rows. It is partitioned by month; a refresh computes the months that have changed and replaces their
partitions only, so the files of all others stay. Running a refresh twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.functions import times

#: Which columns a level groups by, besides the month.
LEVELS = {"cell": ("crm_cd_desc", "vict_descent"), "type": ("crm_cd_desc",), "descent": ("vict_descent",), "month": ()}
DIMENSIONS = ("crm_cd_desc", "vict_descent")


def _dated(crime: DataFrame, date: str) -> DataFrame:
    return crime.select(F.trunc(F.col(date).cast("date"), "month").alias("month_date"), *DIMENSIONS)


def cells(crime: DataFrame, date: str = "date_occ") -> DataFrame:
    """level, month_date, crm_cd_desc, vict_descent, n; one pass for all levels. Rows without a date form a month."""
    dated = _dated(crime, date)
    sets = [[F.col("month_date"), *map(F.col, dims)] for dims in LEVELS.values()]
    counted = dated.groupingSets(sets, "month_date", *DIMENSIONS).agg(
        F.grouping("crm_cd_desc").alias("no_type"), F.grouping("vict_descent").alias("no_descent"), F.count(F.lit(1)).alias("n")
    )
    level = F.lit(None)
    for name, dims in LEVELS.items():
        left_out = [int(d not in dims) for d in DIMENSIONS]
        level = F.when((F.col("no_type") == left_out[0]) & (F.col("no_descent") == left_out[1]), name).otherwise(level)
    return counted.select(level.alias("level"), "month_date", *DIMENSIONS, "n")


def _write(found: DataFrame, path: str) -> None:
    # A month has few rows, so it is one file; Spark replaces the months that occur and no others.
    dealt = found.repartition("month_date").sortWithinPartitions("level", *DIMENSIONS)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_date").parquet(path)


def build(crime: DataFrame, path: str, date: str = "date_occ") -> None:
    """Write the whole table."""
    _write(cells(crime, date), path)


def refresh(crime: DataFrame, added: DataFrame, path: str, date: str = "date_occ") -> None:
    """Bring the table up to date after rows were added to ``crime`` (which holds them): only their months are read and written."""
    months = _dated(added, date).select("month_date").distinct()
    touched = crime.withColumn("_month", F.trunc(F.col(date).cast("date"), "month")).alias("c")
    same = F.col("_month").eqNullSafe(F.col("month_date"))
    _write(cells(touched.join(months, same, "left_semi").drop("_month"), date), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    schema = "level string, crm_cd_desc string, vict_descent string, n long, month_date date"
    return spark.read.schema(schema).parquet(path).select("level", "month_date", *DIMENSIONS, "n")


def _level(cube: DataFrame, types: Sequence[str] | None, descents: Sequence[str] | None) -> DataFrame:
    """The coarsest level that has descents and what is filtered by."""
    found = cube.where(F.col("level") == ("descent" if types is None else "cell"))
    if types is not None:
        found = found.where(F.col("crm_cd_desc").isin(list(types)))
    return found if descents is None else found.where(F.col("vict_descent").isin(list(descents)))


def monthly(cube: DataFrame, types: Sequence[str] | None = None, descents: Sequence[str] | None = None) -> DataFrame:
    """Crimes per month, type and victim descent; both filters may be set together."""
    found = cube.where(F.col("level") == "cell").where(F.col("month_date").isNotNull())
    for column, values in zip(DIMENSIONS, (types, descents)):
        found = found if values is None else found.where(F.col(column).isin(list(values)))
    year, month = F.year("month_date").alias("year"), F.month("month_date").alias("month")
    return found.select(year, month, *DIMENSIONS, "n", times.month_start(F.year("month_date"), F.month("month_date")).alias("month_date"))


def descent_share(cube: DataFrame, types: Sequence[str] | None = None, descents: Sequence[str] | None = None) -> DataFrame:
    """Crimes per victim descent with their percentage of all chosen crimes."""
    counted = _level(cube, types, descents).groupBy("vict_descent").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("percentage", F.col("n") / total * 100)
