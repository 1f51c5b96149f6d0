"""SimHash near-duplicates: pigeonhole blocks find candidate pairs, the Hamming distance verifies them.

A fingerprint has a bit set where more than half of its shingle hashes have it. It is cut into ``BLOCKS`` blocks;
two fingerprints that differ in at most d bits agree on at least ``BLOCKS - d`` whole blocks, so they share the key
made of those blocks for one of the choices. Joining on (choice, key) therefore meets every close pair, and a
key of several blocks is long enough to keep buckets small.

Equal fingerprints are one node, so copies cost nothing. A bucket with more than ``CROWDED`` different
fingerprints is not paired off: as its members agree on the key, they can only differ in the other bits. Each member
is listed under itself and under every fingerprint one of those bits away; for d = 2 two members are
within d bits exactly if they meet in such a list, so linking each list to its least member loses no component
and adds none. That is linear in the bucket.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like any other; fewer words than a
shingle make one shingle; repeated rows are members of their component; NULL ids are members but never name it (a
component of NULL ids only has a NULL id); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cityweave.llm.components import connect
from cityweave.llm.rows import as_row, bound_batches, text_key
from cityweave.sources.scratch import durable

SHINGLE = 3
DISTANCE = 2
BLOCKS = 5
CROWDED = 500
SEED = 42
_AT_ONCE = 1 << 15


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    # bytes.lower() and bytes.split() know only ASCII letters and the six ASCII white-space characters.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += 1 + len(word)
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _AT_ONCE):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + _AT_ONCE], last[i : i + _AT_ONCE])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little").view("<i8")
    return int(packed[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text)


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def block_masks(distance: int, blocks: int = BLOCKS) -> list[int]:
    """For each choice of ``blocks - distance`` blocks the mask of their bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _near_in_crowds(crowded: DataFrame, masks: list[int]) -> DataFrame:
    """Links inside crowded buckets: each list of a fingerprint's neighbours to its least member."""
    flips = F.array(
        *[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(64) if not m >> b & 1]) for m in masks]
    )
    listed = crowded.select(
        "choice",
        "fp",
        F.explode(F.transform(F.element_at(flips, F.col("choice") + 1), lambda x: F.col("fp").bitwiseXOR(x))).alias("near"),
    )
    least = listed.groupBy("choice", "near").agg(F.min("fp").alias("v"))
    return listed.join(least, ["choice", "near"]).select(F.col("fp").alias("u"), "v").where("u <> v")


def close_pairs(fingerprints: DataFrame, distance: int = DISTANCE, crowded_above: int = CROWDED) -> DataFrame:
    """Links (u, v) that connect all of the distinct fingerprints ``fp`` that differ in at most ``distance`` bits."""
    masks = block_masks(distance)
    keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("choice", "key")
    keyed = fingerprints.select("fp", keys)
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = durable(keyed.join(sizes, ["choice", "key"]), "blocks")
    # At a distance of 2 one-bit neighbours on both sides cover all pairs and no others.
    split = distance == 2
    paired = shared.where(F.col("n") <= crowded_above) if split else shared
    a, b = paired.alias("a"), paired.alias("b")
    apart = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    close = (
        (F.col("a.choice") == F.col("b.choice"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (apart <= distance)
    )
    pairs = a.join(b, close).select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v"))
    if split:
        pairs = pairs.unionByName(_near_in_crowds(shared.where(F.col("n") > crowded_above), masks))
    return pairs


def components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, text_key, fp (long), root (a fingerprint of its component)."""
    bound_batches(docs.sparkSession)
    printed = durable(
        docs.select("doc_id", text_key(F.col("text")).alias("text_key"), fingerprint(F.col("text"), shingle).alias("fp")),
        "fingerprints",
    )
    roots = connect(close_pairs(durable(printed.select("fp").distinct(), "distinct-fingerprints"), distance))
    met = printed.join(durable(roots, "roots"), F.col("fp") == F.col("node"), "left")
    return met.select("doc_id", "text_key", "fp", F.coalesce("root", "fp").alias("root"))


def with_component_ids(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id (the least doc_id of its component)."""
    found = durable(components(docs, shingle, distance), "members")
    ids = durable(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return found.join(ids, "root").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least doc_id stays."""
    found = durable(components(docs, shingle, distance), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    stays = found.groupBy("root").agg(first.alias("first")).select("first.doc_id", "first.text_key")
    one = W.partitionBy("doc_id", "text_key").orderBy("doc_id")
    rows = docs.select(as_row(docs).alias("row"), "doc_id", text_key(F.col("text")).alias("text_key"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ("doc_id", "text_key")]
    met = rows.alias("r").join(stays.alias("s"), same, "left_semi")
    return met.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row.*")
