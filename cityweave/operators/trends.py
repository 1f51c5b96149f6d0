"""Counts over time and the tables that feed the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions import times


def with_year_month(df: DataFrame, date: str, year: str = "year", month: str = "month") -> DataFrame:
    return df.withColumns({year: F.year(date), month: F.month(date)})


def monthly_counts(df: DataFrame, date: str, counted: str | None = None) -> DataFrame:
    """Rows per year and month of ``date`` with the month's first day; ``counted`` counts its present values only."""
    dated = df.where(F.col(date).isNotNull()).groupBy(F.year(date).alias("year"), F.month(date).alias("month"))
    n = F.count(F.lit(1) if counted is None else F.col(counted)).alias("n")
    return dated.agg(n).withColumn("month_date", times.month_start("year", "month"))


def yearly_counts(df: DataFrame, date: str, since: int) -> DataFrame:
    """Rows per year of ``date`` from a year on."""
    return df.where(F.year(date) >= since).groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def day_hour_matrix(df: DataFrame, day: Column, hour: Column) -> DataFrame:
    """Weekday by hour, Monday first, all seven days and 24 hours; cells without a row stay NULL.

    Rows of a day whose hour is unknown or outside 0 to 23 (a time of 2400) count as ``not_listed``.
    """
    ranked = df.select(times.weekday_rank(day).alias("day_rank"), hour.alias("hour"))
    cells = ranked.groupBy("day_rank", "hour").agg(F.count(F.lit(1)).alias("n"))
    hours = [F.sum(F.when(F.col("hour") == h, F.col("n"))).alias(f"h{h:02d}") for h in range(24)]
    unlisted = ~F.coalesce(F.col("hour").between(0, 23), F.lit(False))
    counted = cells.groupBy("day_rank").agg(*hours, F.sum(F.when(unlisted, F.col("n"))).alias("not_listed"))
    week = df.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("day_rank"))
    names = F.element_at(F.array(*[F.lit(d) for d in times.DAYS]), F.col("day_rank"))
    return (
        week.join(F.broadcast(counted), "day_rank", "left")
        .select("day_rank", names.alias("day_of_week"), *counted.columns[1:])
        .orderBy("day_rank")
    )


def _chosen(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return df if values is None else df.where(F.col(column).isin(list(values)))


def dashboard_monthly(
    crime: DataFrame, date: str = "date_occ", types: Sequence[str] | None = None, descents: Sequence[str] | None = None
) -> DataFrame:
    """Crimes per month, type and victim descent; both filters may be set together."""
    chosen = _chosen(_chosen(crime, "crm_cd_desc", types), "vict_descent", descents)
    return (
        chosen.where(F.col(date).isNotNull())
        .groupBy(F.year(date).alias("year"), F.month(date).alias("month"), "crm_cd_desc", "vict_descent")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("month_date", times.month_start("year", "month"))
    )


def dashboard_descent_share(
    crime: DataFrame, types: Sequence[str] | None = None, descents: Sequence[str] | None = None
) -> DataFrame:
    """Crimes per victim descent with their percentage of all chosen crimes."""
    chosen = _chosen(_chosen(crime, "crm_cd_desc", types), "vict_descent", descents)
    counted = chosen.groupBy("vict_descent").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("percentage", F.col("n") / total * 100)
