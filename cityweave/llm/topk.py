"""Exact top-k search by inner product with a table of distances to pivots.

Every vector keeps its distances to ``PIVOTS`` pivots. For a query q and a candidate x the largest
|d(q, p) - d(x, p)| over all pivots is a lower bound of d(q, x), and as 2 q.x = |q|^2 + |x|^2 - d(q, x)^2 that is an
upper bound of the score. Candidates are evaluated in order of their bound until the k-th best score is above
every bound that is left; ties are evaluated too. So the result is exact whatever the pivots are.

Rows are cut into blocks of bounded size by a hash, queries likewise; each pair of a query block and a row block is
one bounded group of work, which gives the best k per query. The best k of all blocks follow by a ranked window
that first cuts to k inside each task.

Vectors with a component of 2^25 or more, or a squared length of 2^62 or more, are too large for the arithmetic of the table; all
pairs they are in are evaluated apart, in blocks, with Python's whole numbers.

Defined results: components become floor(64 * x). A vector that is NULL or has a NULL or non-finite component takes no part.
A score beyond the range of a long counts as the least or largest long. An empty table gives no rows. Shorter vectors are filled
up with zeros. A query's candidates are all rows with another vec_id; a NULL id asks nothing and comes last among ties.
Of query rows with one vec_id the least vector asks; repeated rows are candidates of their own.
"""

from __future__ import annotations

import heapq
import math
import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cityweave.llm.rows import bound_batches
from cityweave.sources.scratch import durable

K = 20
EVERY = 20
PIVOTS = 16
PIVOT_SAMPLE = 512  # rows from which the pivots are picked, by a hash of their ids
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 1024
FIRST_PART = 256
GROWTH = 8
LARGEST_SQUARE = 1 << 62
_NO_ID = np.iinfo(np.int64).max
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1
WIDE_BLOCK = 2048
KIND = "query_id long, vec_id long, score long, evaluated long"


def _finite() -> Column:
    return F.coalesce(
        F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))),
        F.lit(False),
    )


def _fits() -> Column:
    """All products and sums of such vectors lie in the range of a long."""
    square = F.aggregate(
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 64)),
        F.lit(0.0),
        lambda total, x: total + x.cast("double") * x.cast("double"),
    )
    small = F.forall("embedding", lambda x: F.abs(x.cast("double")) * 64 < float(1 << 31))
    return F.when(_finite() & small, square < float(LARGEST_SQUARE)).otherwise(False)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of long) of the rows whose whole numbers fit; the few others are ``wide``."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long"))
    return vectors.where(_fits()).select("vec_id", scaled.alias("v"))


def wide(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the finite rows with too large numbers."""
    return vectors.where(_finite() & ~_fits()).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))


def exact_numbers(embedding) -> list[int]:
    """floor(64 * x) of finite doubles, however large."""
    return [64 * int(x) if abs(x) >= 2.0**53 else math.floor(64 * x) for x in embedding]


def _search_wide(vectors: DataFrame, wide_rows: DataFrame, k: int, every: int) -> DataFrame:
    """Best ``k`` per block of all pairs with a wide side, with Python's whole numbers; columns as of the main search.

    Queries meet candidates block by block, as many as there are; a task holds one block of each.
    """
    ordinary = vectors.where(_fits()).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    asks = (F.col("vec_id") % every == 0) & F.col("vec_id").isNotNull()

    def best(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        candidates = [(i, exact_numbers(v)) for i, v in zip(x["vec_id"], x["embedding"])]
        for query_id, embedding in zip(q["vec_id"], q["embedding"]):
            query = exact_numbers(embedding)
            exact = ((i, sum(map(operator.mul, query, v))) for i, v in candidates if i != query_id)
            scores = [(i, min(max(s, LEAST_LONG), MOST_LONG)) for i, s in exact]
            top = heapq.nsmallest(k, scores, key=lambda s: (-s[1], s[0]))
            out += [(query_id, i, s, len(scores)) for i, s in top]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "evaluated"], dtype="int64")

    def met(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        n_queries, n_rows = queries.count(), candidates.count()
        row_blocks, query_blocks = n_rows // WIDE_BLOCK + 1, n_queries // WIDE_BLOCK + 1
        queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
        left = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        left = left.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
        right = candidates.withColumn("vec_id", F.coalesce("vec_id", F.lit(_NO_ID)))
        right = right.withColumn("rb", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(row_blocks)).cast("int"))
        right = right.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        return left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInPandas(best, KIND)

    every_row = ordinary.unionByName(wide_rows)
    return met(every_row.where(asks), wide_rows).unionByName(met(wide_rows.where(asks), ordinary))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def pick_pivots(rows: DataFrame, width: int, n: int = PIVOTS) -> np.ndarray:
    """``n`` vectors far from each other: each is the farthest from those before it, out of a bounded sample."""
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOT_SAMPLE).select("v").collect()
    found = matrix(pd.Series([r.v for r in sample], dtype=object), width).astype(float)
    chosen = [0]
    nearest = np.linalg.norm(found - found[0], axis=1)
    while len(chosen) < min(n, len(found)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(found - found[chosen[-1]], axis=1))
    return found[chosen]


def distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Pivots x rows."""
    m = m.astype(float)
    return np.stack([np.sqrt(((m - p) ** 2).sum(axis=1)) for p in pivots])


def best_of(
    query: np.ndarray, query_id: int, reach: np.ndarray, rows: np.ndarray, ids: np.ndarray, table: np.ndarray,
    squares: np.ndarray, k: int,
) -> tuple[list[tuple[int, int]], int]:
    """The best k (vec_id, score) of a block for one query, and how many rows were evaluated.

    Rows are taken in parts of growing size in order of their bound; within a part the order is of no use.
    """
    lower = np.zeros(len(ids), table.dtype)
    for mine, theirs in zip(reach.astype(table.dtype), table):
        np.maximum(lower, np.abs(theirs - mine), out=lower)
    square = float((query * query).sum())
    bound = squares - lower * lower
    # Rounding must not push a bound below a score.
    slack = 1 + 8 * np.finfo(table.dtype).eps * (float(squares.max(initial=0)) + float(table.max(initial=0)) ** 2 + square)
    bound = 0.5 * (bound + square) + slack
    left = np.flatnonzero(ids != query_id)
    met, scores, seen, part = left[:0], np.empty(0, np.int64), 0, FIRST_PART
    while len(left):
        now = left
        if len(left) > part:
            order = np.argpartition(bound[left], len(left) - part)
            left, now = left[order[:-part]], left[order[-part:]]
        else:
            left = left[:0]
        seen += len(now)
        # Nearly all rows of the block: faster in place than copied.
        found = (rows @ query)[now] if 2 * len(now) > len(ids) else rows[now] @ query
        met, scores = np.concatenate([met, now]), np.concatenate([scores, found.astype(np.int64)])
        if len(scores) >= k:
            worst = np.partition(scores, len(scores) - k)[len(scores) - k]
            good = scores >= worst
            met, scores = met[good], scores[good]
            left = left[bound[left] >= worst]
        part *= GROWTH
    top = np.lexsort((ids[met], -scores))[:k]
    return [(int(ids[met[i]]), int(scores[i])) for i in top], seen


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``k`` of each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = durable(whole_numbers(vectors), "vectors")
    asks = (F.col("vec_id") % every == 0) & F.col("vec_id").isNotNull()
    n, width, n_queries, largest = rows.agg(
        F.count("*"),
        F.max(F.size("v")),
        F.count_if(asks),
        F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)),
    ).first()
    wide_rows = durable(wide(vectors), "wide-vectors")
    any_wide = wide_rows.limit(1).count() > 0
    if not n or not n_queries:
        found = _search_wide(vectors, wide_rows, k, every) if any_wide else spark.createDataFrame([], KIND)
        return _ranked(found, k)
    pivots = pick_pivots(rows, width)
    # Sums of products stay below the largest squared length; up to 2^53 doubles are exact, and faster.
    number = np.float64 if largest < 1 << 52 else np.int64

    @F.pandas_udf("array<double>")
    def to_pivots(v: pd.Series) -> pd.Series:
        return pd.Series(list(distances(matrix(v, width), pivots).T), dtype=object)

    tabled = durable(rows.withColumn("reach", to_pivots("v")), "pivot-table")
    row_blocks, query_blocks = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(n_queries / BLOCK_QUERIES))

    def all_blocks(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    queries = (
        tabled.where(asks)
        .groupBy("vec_id")
        .agg(F.min(F.struct("v", "reach")).alias("least"))
        .select("vec_id", "least.*")
        .withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("rb", all_blocks(row_blocks))
    )
    # The table is read from its files, so the numbers of its rows stay the same if a task is repeated.
    candidates = (
        tabled.withColumn("vec_id", F.coalesce("vec_id", F.lit(_NO_ID)))
        .withColumn("rb", F.pmod(F.monotonically_increasing_id(), F.lit(row_blocks)).cast("int"))
        .withColumn("qb", all_blocks(query_blocks))
    )

    def pair(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(x):
            m = matrix(x["v"], width)
            table = np.stack(x["reach"].to_list(), axis=1)
            squares = (m.astype(float) ** 2).sum(axis=1)
            if largest < 1 << 40:  # half the memory traffic; the bounds allow for the rounding
                table, squares = table.astype(np.float32), squares.astype(np.float32)
            ids = x["vec_id"].to_numpy(np.int64)
            m = m.astype(number)
            for query_id, v, reach in zip(q["vec_id"], matrix(q["v"], width).astype(number), q["reach"]):
                found, seen = best_of(v, int(query_id), reach, m, ids, table, squares, k)
                out += [(int(query_id), i, s, seen) for i, s in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "evaluated"], dtype="int64")

    keys = ["qb", "rb"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(pair, KIND)
    if any_wide:
        found = found.unionByName(_search_wide(vectors, wide_rows, k, every))
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(_NO_ID)).alias("vec_id"), "score")
