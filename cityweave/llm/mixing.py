"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Sources share ``budget`` times all words by weight. A target stops at ``cap`` times the size of its source and
the excess goes to the others by weight until none is above. Within a source every document expects
``target / source size`` copies. The expected copies are summed up in order of size, one random offset is added,
and a document is emitted once for each integer boundary that its interval crosses. As sizes are in order, what a
source gives differs from its target by less than its longest document, and as no rate is above ``cap``, no
document is taken more often than ``cap`` times.

A window over a whole source would put the hottest source into one task. Instead the narrow rows are
range-partitioned by (source, size, id), so a source spans as many tasks as its rows need; each task numbers its
own rows, and only the row counts per task and source are summed up. The numbered rows are written once, so all
later steps see the same numbers.

Defined results: NULL text has size 0; NULL is a source of its own, last in order; a source of size 0 gets nothing;
equal sizes are in order of doc_id; repeated rows are sampled one by one; an empty table gives an empty mix. The
number of *sources* is a matter of configuration (each has a weight), so their table may pass through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cityweave.llm.rows import as_row, text_key, word_count
from cityweave.sources.scratch import durable

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2.0
SEED = 7
_POSITION_BITS = 33  # of monotonically_increasing_id: row within its partition


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, cap: float) -> DataFrame:
    """From rows (source, size): source, source_size, target."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    full = F.col("source_size") * F.lit(cap)
    # In order of full / weight the sources that reach their cap come first.
    order = W.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    level = (F.col("to_share") - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    shared = (
        sources.withColumn("weight", weight)
        .withColumn("to_share", F.sum("source_size").over(whole) * F.lit(budget))
        .withColumns({"level": level, "place": F.row_number().over(order)})
        .withColumn("first_open", F.min(F.when(F.col("level") * F.col("weight") < full, F.col("place"))).over(whole))
        .withColumn("level", F.max(F.when(F.col("place") == F.col("first_open"), F.col("level"))).over(whole))
    )
    open_ = F.col("place") >= F.col("first_open")
    target = F.when(open_, F.least(F.col("level") * F.col("weight"), full)).otherwise(full)
    return shared.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source, a multiple of 1/65536 in [0, 1): exact when added to large sums."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("long") / F.lit(65536.0)


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, text_key, source, size, source_size, target, copies, taken."""
    narrow = durable(
        docs.select("doc_id", "source", text_key(F.col("text")).alias("text_key"), word_count(F.col("text")).alias("size")),
        "mix-sizes",
    )
    key = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id"), F.col("text_key")]
    numbered = durable(
        narrow.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id()),
        "mix-order",
    )
    part = F.shiftright("at", _POSITION_BITS)
    parts = numbered.groupBy(part.alias("part"), "source").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    running = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = parts.withColumn("start", F.sum("n").over(running) - F.col("n"))
    targets = source_targets(narrow, weights, budget, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    pieces = durable(
        starts.alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("part", "s.source", "first", "start", "source_size", "target", rate.alias("rate"), offset(F.col("s.source"), seed).alias("offset")),
        "mix-parts",
    )
    mine = (part == F.col("p.part")) & F.col("d.source").eqNullSafe(F.col("p.source"))
    place = F.col("start") + F.col("at") - F.col("first")
    crossed = F.floor(F.col("rate") * (place + 1) + F.col("offset")) - F.floor(F.col("rate") * place + F.col("offset"))
    return (
        numbered.alias("d")
        .join(pieces.alias("p"), mine)
        .select("doc_id", "text_key", "d.source", "size", "source_size", "target", crossed.cast("long").alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken. ``settings`` as for ``plan_mix``.

    Rows meet their number of copies by doc_id and text; of repeated rows each gets one of the numbers.
    """
    same = W.partitionBy("doc_id", "text_key", "source").orderBy("copies")
    copies = plan_mix(docs, **settings).select("doc_id", "text_key", "source", "copies").withColumn("nth", F.row_number().over(same))
    one = W.partitionBy("doc_id", "text_key", "source").orderBy("doc_id")
    rows = docs.select(as_row(docs).alias("row"), "doc_id", "source", text_key(F.col("text")).alias("text_key")).withColumn(
        "nth", F.row_number().over(one)
    )
    keys = ["doc_id", "text_key", "source", "nth"]
    met = rows.alias("r").join(
        copies.where("copies > 0").alias("c"), [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    )
    return met.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
