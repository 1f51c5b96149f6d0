"""Connected components by alternating large and small stars, each round a few joins and aggregates.

Every round is written to the shared folder, so lineage stays short and survives lost executors.

Defined results: links may be repeated, in either direction, and from a node to itself, which gives no component; nodes without
a link are not returned; no links give no rows. Ids must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.sources.scratch import durable


def _pointed(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with u > v, each once."""
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _with_least(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to the least node around it."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _with_least(both).where("v > u")
    return _pointed(met.select(F.col("v").alias("u"), F.least("m", "u").alias("v")))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node joins itself and its smaller neighbours to the least of them."""
    met = _with_least(pairs)
    moved = F.explode(F.array("u", "v"))
    return _pointed(met.select(moved.alias("u"), F.col("m").alias("v")))


def connect(links: DataFrame) -> DataFrame:
    """From links (u, v) between long ids: node, root (the least id of its component), for nodes with a link."""
    current, seen = durable(_pointed(links), "links"), None
    while True:
        n, mark = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (n, mark) == seen or n == 0:
            break
        seen = (n, mark)
        current = durable(_small_star(_large_star(current)), "links")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
