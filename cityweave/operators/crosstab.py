"""Cross-tabulation, row percentages and the chi-square test of independence.

Everything starts from the long table of observed cells (row value, column value, n). It is small and its
marginals are needed again and again, so it is written once; the rows are scanned a single time. Empty
cells are added only where a result has to show them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.chisquare import tail_probability
from cityweave.operators.profile import counts_by
from cityweave.sources.scratch import durable


def observed_cells(df: DataFrame, row: str, column: str) -> DataFrame:
    return durable(counts_by(df, row, column), "cells")


def wide(df: DataFrame, row: str, column: str, values: Sequence, names: Sequence[str] | None = None, empty=0) -> DataFrame:
    """One row per row value, one column per entry of ``values`` and ``not_listed`` for all others, so that a row adds up.

    ``empty=None`` leaves empty cells NULL.
    """
    cells = counts_by(df.dropna(subset=[row, column]), row, column)

    def total(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(empty)).cast("long")

    counts = [total(F.col(column) == v).alias(n) for v, n in zip(values, names or values)]
    return cells.groupBy(row).agg(*counts, total(~F.col(column).isin(list(values))).alias("not_listed"))


def with_totals(cells: DataFrame, row: str, column: str) -> DataFrame:
    """Observed cells with row, column and grand total and the count expected under independence."""
    rows = cells.groupBy(row).agg(F.sum("n").alias("row_total"))
    columns = cells.groupBy(column).agg(F.sum("n").alias("column_total"))
    return (
        cells.join(rows, row)
        .join(columns, column)
        .withColumn("total", cells.agg(F.sum("n")).scalar())
        .withColumn("expected", F.col("row_total") * F.col("column_total") / F.col("total"))
    )


def full_table(cells: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Every row value with every entry of ``values`` and every other cell observed: n (0 for empty cells), totals, expected.

    Empty cells come from ``values``, a short parameter list (bin labels, a top-k list), never from the data.
    """
    listed = cells.select(row).distinct().withColumn(column, F.explode(F.array(*map(F.lit, values))))
    filled = cells.unionByName(listed.withColumn("n", F.lit(0).cast("long"))).groupBy(row, column).agg(F.sum("n").alias("n"))
    return with_totals(filled, row, column)


def row_share(
    cells: DataFrame, row: str, column: str, scale: float = 1.0, name: str = "share", values: Sequence | None = None
) -> DataFrame:
    """Each observed cell as a part of its row; with ``values`` also their empty cells, as 0."""
    table = with_totals(cells, row, column) if values is None else full_table(cells, row, column, values)
    return table.select(row, column, "n", (F.col("n") / F.col("row_total") * scale).alias(name))


def chi_square(cells: DataFrame, row: str, column: str, alpha: float = 0.05) -> DataFrame:
    """One row: statistic, degrees of freedom, p-value, verdict at ``alpha``.

    Empty cells need not be listed: each adds exactly its expected count, and together they add the total
    minus the expected counts of the observed cells. With one degree of freedom every deviation is reduced
    by at most one half (Yates).
    """
    table = with_totals(cells, row, column)
    deviation = F.abs(F.col("n") - F.col("expected"))
    summed = table.agg(
        F.sum(deviation * deviation / F.col("expected")).alias("plain"),
        F.sum(_yates(deviation) / F.col("expected")).alias("corrected"),
        F.sum("expected").alias("listed"),
        F.max("total").alias("total"),
        F.count(F.lit(1)).alias("n_cells"),
    )
    sized = summed.withColumns(
        {
            "n_rows": cells.agg(F.count_distinct(row)).scalar(),
            "n_columns": cells.agg(F.count_distinct(column)).scalar(),
        }
    )
    empty = F.col("n_rows") * F.col("n_columns") - F.col("n_cells")
    rest = F.when(empty > 0, F.col("total") - F.col("listed")).otherwise(0.0)
    # A 2 x 2 table has at most two empty cells, and then both have the same expected count.
    each = rest / F.greatest(empty, F.lit(1))
    rest_corrected = F.when((empty > 0) & (each > 0), empty * _yates(each) / each).otherwise(0.0)
    dof = (F.col("n_rows") - 1) * (F.col("n_columns") - 1)
    statistic = F.when(dof == 1, F.col("corrected") + rest_corrected).when(dof > 1, F.col("plain") + rest).otherwise(0.0)
    tested = sized.select(statistic.alias("statistic"), dof.alias("dof"))
    p = F.when(F.col("dof") == 0, 1.0).otherwise(tail_probability(F.col("statistic"), F.col("dof")))
    verdict = F.when(F.col("p_value") < alpha, "significant").otherwise("not significant")
    return tested.withColumn("p_value", p).withColumn("verdict", verdict)


def _yates(deviation: Column) -> Column:
    reduced = deviation - F.least(deviation, F.lit(0.5))
    return reduced * reduced
