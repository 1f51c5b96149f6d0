"""Exact interpolated quantiles, per group or for the whole table, in two scans.

The first scan counts, sums up whatever else is asked for, and sketches the values: of the mergeable sketch only two values
around each quantile are kept, further from it than the sketch can be off. The second counts what lies below such a bracket
and orders the different values inside. Both use partial aggregation; none collects a group.

A bracket of more than ``few`` values is first narrowed: it is split into equal parts, which are counted, and the part that
holds the wanted rank goes on, until it holds few values or a single one. The two ends of a range never share a part, so every
pass narrows it. Weighted values, which the sketch cannot see, start with their whole range. Should a rank not lie in its
bracket, it is looked for in the whole range; so results are exact whatever the sketch says.

Infinite values are counted apart, as no range with them can be split.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.functions.numbers import is_number
from cityweave.operators.skew import join_per_key
from cityweave.sources.scratch import durable

# Rows in a range up to which it is not split again; its different values are put in order by one task.
FEW_VALUES = 500_000
PARTS = 65_536
# The sketch's rank error is one part in so many; the sketch of a group is smaller, as there may be many.
ACCURACY = 10_000
GROUP_ACCURACY = 1_000


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
    few: int = FEW_VALUES,
) -> DataFrame:
    """One row per group with a column per entry of ``probabilities``; NULL and NaN values are left out.

    ``weight`` names a column that says how often a row counts.
    """
    return with_rows(df, value, probabilities, by, weight, few).drop("rows")


def with_rows(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    by: Sequence[str],
    weight: str | None,
    few: int,
    also: Sequence[Column] = (),
) -> DataFrame:
    """The same with the number of rows of each group in ``rows``, and the aggregates ``also`` over the values ``v``."""
    by = list(by)
    numbers = weighted_numbers(df, value, by, weight)
    finite, v, w = F.abs("v") < math.inf, F.col("v"), F.col("w")

    def weight_of(end: float) -> Column:
        return F.coalesce(F.sum(F.when(v == end, w)), F.lit(0))

    accuracy = GROUP_ACCURACY if by else ACCURACY
    around = [min(max(p + d / accuracy, 0.0), 1.0) for p in probabilities.values() for d in (-2, 2)]
    sketch = F.percentile_approx(v, around, accuracy) if weight is None else F.lit(None).cast("array<double>")
    profile = numbers.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum("w").alias("n"),
        weight_of(-math.inf).alias("n_lowest"),
        weight_of(math.inf).alias("n_highest"),
        F.min(F.when(finite, v)).alias("low"),
        F.max(F.when(finite, v)).alias("high"),
        sketch.alias("around"),
        F.struct(F.lit(0).alias("none"), *also).alias("also"),
    )
    profile = durable(profile, "quantile-profile")
    known = profile.where(F.col("n") > 0)
    names = F.array(
        *[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p"), F.lit(i).alias("i")) for i, (k, p) in enumerate(probabilities.items())]
    )
    wanted = known.withColumn("wanted", F.explode(names)).select(
        *by, "rows", "n", "n_lowest", "n_highest", "low", "high", "wanted.name",
        F.greatest("low", F.get("around", 2 * F.col("wanted.i"))).alias("from"),
        F.least("high", F.get("around", 2 * F.col("wanted.i") + 1)).alias("to"),
        (F.col("wanted.p") * (F.col("n") - 1)).alias("position"),
    )
    both_ranks = F.array_distinct(F.array(F.floor("position"), F.ceil("position")))  # counted from 0
    ranks = wanted.withColumn("rank", F.explode(both_ranks)).groupBy(
        *by, "rank", "rows", "n", "n_lowest", "n_highest", "low", "high"
    )
    ranks = ranks.agg(F.min("from").alias("from"), F.max("to").alias("to"))
    end = F.when(F.col("rank") < F.col("n_lowest"), F.lit(-math.inf)).when(
        F.col("rank") >= F.col("n") - F.col("n_highest"), F.lit(math.inf)
    )
    ranks = ranks.withColumn("end", end)
    middle, inside = ranks.where("end is null"), F.col("n") - F.col("n_lowest") - F.col("n_highest")
    share = 1.0 if weight is not None else min(1.0, 6 / accuracy)
    # Nothing lies below the whole range, so counting from below is right for it, too.
    state = middle.select(
        *by, "rows", F.col("from").alias("low"), F.col("to").alias("high"), F.lit(True).alias("below"), "rank",
        F.ceil(inside * share).alias("n"), (F.col("rank") - F.col("n_lowest")).alias("local"),
    )
    ends = ranks.where("end is not null").select(*by, "rank", F.col("end").alias("v"))
    values = durable(_values_at(numbers.where(finite), state, by, few).unionByName(ends), "quantile-values")
    missed = middle.join(values, [*by, "rank"], "left_anti")
    if weight is None and missed.limit(1).count():
        state = missed.select(
            *by, "rows", "low", "high", F.lit(True).alias("below"), "rank",
            inside.alias("n"), (F.col("rank") - F.col("n_lowest")).alias("local"),
        )
        state = durable(state, "quantile-ranks")
        values = durable(values.unionByName(_values_at(numbers.where(finite), state, by, few)), "quantile-values")
    below, above = values.withColumnsRenamed({"rank": "r0", "v": "v0"}), values.withColumnsRenamed({"rank": "r1", "v": "v1"})
    lower = wanted.withColumns({"r0": F.floor("position"), "r1": F.ceil("position")})
    both = lower.join(below, [*by, "r0"]).join(above, [*by, "r1"])
    share = F.col("position") - F.col("r0")
    between = (1 - share) * F.col("v0") + share * F.col("v1")
    result = F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise(between)
    found = both.groupBy(*by).agg(*[F.max(F.when(F.col("name") == k, result)).alias(k) for k in probabilities])
    facts = profile.select(*by, "rows", "also.*").drop("none")
    if by:
        return found.join(facts, by)
    # One row each, none of them if there are no values.
    return facts.withColumn("found", found.select(F.struct(*probabilities)).scalar()).select("*", "found.*").drop("found")


def weighted_numbers(df: DataFrame, value: str, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Columns ``by``, v (double) and w of the rows that have a number and a group."""
    w = F.lit(1) if weight is None else F.col(weight)
    kept = F.lit(True)
    for c in by:
        kept = kept & F.col(c).isNotNull()
    return df.where(kept).select(*by, F.col(value).cast("double").alias("v"), w.cast("long").alias("w")).where(
        is_number("v") & (F.col("w") > 0)
    )


def _values_at(numbers: DataFrame, state: DataFrame, by: list[str], few: int) -> DataFrame:
    """by, rank, v: the value at each rank of ``state``, where ``local`` is the rank within the range."""
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    spread = high - low
    # The width of a range may be too large for a double; that of its half is not.
    share = F.when(spread < math.inf, (v - low) / spread).otherwise((v / 2 - low / 2) / (high / 2 - low / 2))
    part = F.when(spread > 0, F.least(F.floor(share * PARTS), F.lit(PARTS - 1))).otherwise(0)
    part = F.when(v < low, -1).otherwise(part)
    while _most_values(state) > few:
        counted = (
            _within(numbers, state, by)
            .groupBy(*by, "low", "high", part.alias("part"))
            .agg(F.sum("w").alias("n"), F.min("v").alias("part_low"), F.max("v").alias("part_high"))
        )
        picked = _pick(state, counted, by, "part").withColumn("local", F.col("local") - F.col("before"))
        picked = picked.where("part >= 0").withColumn("below", F.lit(False))
        narrowed = picked.drop("low", "high").withColumnsRenamed({"part_low": "low", "part_high": "high"})
        state = durable(narrowed.select(*state.columns), "quantile-ranks")
    # What lies below a range is one value, NULL, which comes first.
    inside = F.when(v >= low, v).alias("v")
    single = _within(numbers, state, by).groupBy(*by, "low", "high", inside).agg(F.sum("w").alias("n"))
    return _pick(state, single, by, "v").where("v is not null").select(*by, "rank", "v")


def _most_values(state: DataFrame) -> int:
    """Rows in the fullest range that still holds different values."""
    return state.where("high > low").agg(F.max("n")).first()[0] or 0


def _within(numbers: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """Values that lie in a range still of interest, or below it where that counts. At most two ranges per probability."""
    ranges = F.collect_set(F.struct("low", "high", "below")).alias("ranges")
    if by:
        met = join_per_key(numbers, state.groupBy(*by).agg(ranges, F.max("rows").alias("rows")), by, "rows")
    else:
        met = numbers.withColumn("ranges", state.agg(ranges).scalar())
    inside = (F.col("v") <= F.col("range.high")) & (F.col("range.below") | (F.col("v") >= F.col("range.low")))
    return met.withColumn("range", F.explode("ranges")).where(inside).select(*by, "range.low", "range.high", "v", "w")


def _pick(state: DataFrame, counted: DataFrame, by: list[str], order: str) -> DataFrame:
    """The counted part that each wanted rank falls into, with the number of values ``before`` it."""
    running = Window.partitionBy(*by, "low", "high").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    located = counted.withColumn("upto", F.sum("n").over(running)).withColumn("before", F.col("upto") - F.col("n"))
    hit: Column = (F.col("local") >= F.col("before")) & (F.col("local") < F.col("upto"))
    return located.join(state.drop("n"), [*by, "low", "high"]).where(hit)
