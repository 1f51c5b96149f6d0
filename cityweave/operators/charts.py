"""Datasets behind the charts: histogram, box plot and density curve. Nothing is drawn here."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.functions.numbers import is_number
from cityweave.operators.quantiles import FEW_VALUES, weighted_numbers, with_rows
from cityweave.operators.skew import join_per_key
from cityweave.sources.scratch import durable

HISTOGRAM_BINS = 30
CURVE_POINTS = 200
CURVE_PARTS = 4096


def _numbers(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("double").alias("v")).where(is_number("v"))


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over the range of a column; each includes its lower edge, the last also its upper.

    A bin is computed from the width and then corrected against the edges themselves, so a value on an
    edge is never misplaced by rounding. Empty bins are listed with 0.
    """
    numbers = _numbers(df, column)
    ends = numbers.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    flat = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ends = ends.select(F.struct((F.col("low") - flat).alias("low"), (F.col("high") + flat).alias("high")))
    low, high = F.col("ends.low"), F.col("ends.high")
    width = (high - low) / bins

    guess = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
    down = F.when(F.col("v") < low + guess * width, -1).otherwise(0)
    up = F.when((F.col("v") >= low + (guess + 1) * width) & (guess < bins - 1), 1).otherwise(0)
    counted = (
        numbers.withColumn("ends", ends.scalar())
        .groupBy((guess + down + up + 1).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), ends.scalar().alias("ends"))
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("lower_edge"),
        F.when(F.col("bin") == bins, high).otherwise(low + F.col("bin") * width).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_plot(
    df: DataFrame, group: str, column: str, weight: str | None = None, few: int = FEW_VALUES
) -> DataFrame:
    """Per group: size, quartiles, whiskers at the last value within 1.5 quartile ranges, outliers beyond.

    ``weight`` names a column that says how often a row counts.
    """
    levels = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = durable(with_rows(df, column, levels, [group], weight, few), "box-quartiles")
    v, w, reach = F.col("v"), F.col("w"), 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    joined = join_per_key(weighted_numbers(df, column, [group], weight), quartiles, [group], "rows")
    return joined.groupBy(group, *levels).agg(
        F.sum("w").alias("n"),
        F.least(F.min(F.when(v >= low, v)), F.col("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(v <= high, v)), F.col("q3")).alias("whisker_high"),
        F.sum(F.when((v < low) | (v > high), w).otherwise(0)).alias("n_outliers"),
    )


def density(df: DataFrame, column: str, points: int = CURVE_POINTS, bins: int | None = CURVE_PARTS) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, bandwidth after Scott.

    ``n_curve`` is the same curve on the scale of a 30-bin histogram. The values are first summed into ``bins`` equal
    parts (count, mean and variance of each), so the cost of the curve does not depend on the number of rows. The
    kernel of a part is expanded to second order about its mean; its third derivative is below 1.4 / bandwidth^3, so the density
    is off by less than 0.1 (part width / bandwidth)^3 / bandwidth. ``bins=None`` gives the exact curve: every *different*
    value contributes to every grid point.
    """
    numbers = _numbers(df, column)
    facts = numbers.agg(
        F.struct(
            F.count("v").alias("n"), F.stddev_samp("v").alias("std"), F.min("v").alias("low"), F.max("v").alias("high")
        )
    ).scalar()
    n, low, high = F.col("facts.n"), F.col("facts.low"), F.col("facts.high")
    # Values that are all equal have no density; the curve is NULL then.
    bandwidth = F.when(F.col("facts.std") > 0, F.col("facts.std")) * F.pow(n.cast("double"), F.lit(-0.2))
    x = low + F.col("point") * ((high - low) / (points - 1))
    if bins is None:
        same = numbers.groupBy("v").agg(F.count("v").cast("double").alias("weight"))
        parts = same.withColumn("variance", F.lit(0.0))
    else:
        part = F.least(F.floor((F.col("v") - low) / F.nullif(high - low, F.lit(0.0)) * bins), F.lit(bins - 1))
        parts = (
            numbers.withColumn("facts", facts)
            .groupBy(part.alias("part"))
            .agg(F.avg("v").alias("v"), F.count("v").cast("double").alias("weight"), F.var_pop("v").alias("variance"))
        )
    z = (F.col("x") - F.col("v")) / F.col("bandwidth")
    kernel = F.exp(-0.5 * z * z)
    if bins is not None:
        kernel = kernel * (1 + F.col("variance") / (2 * F.col("bandwidth") * F.col("bandwidth")) * (z * z - 1))
    summed = (
        parts.withColumn("facts", facts)
        .select("v", "weight", "variance", "facts", bandwidth.alias("bandwidth"))
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .groupBy("point")
        .agg(F.sum(F.col("weight") * kernel).alias("mass"))
    )
    scale = n * F.col("bandwidth") * math.sqrt(2 * math.pi)
    return (
        summed.withColumn("facts", facts)
        .withColumn("bandwidth", bandwidth)
        .select(
            "point",
            x.alias("x"),
            (F.col("mass") / scale).alias("density"),
            (F.col("mass") / scale * n * (high - low) / HISTOGRAM_BINS).alias("n_curve"),
        )
    )
