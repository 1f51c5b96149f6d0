"""Spelling variants of the words of a corpus, found with Gram matrices of letter counts.

1. Runs of letters are counted per document, then per batch of documents, then by one aggregate.
2. Words are dealt into blocks by length and by how many of their letters fall into each of ``GROUPS`` fixed groups of
   letters. One inserted letter raises one of these counts by one; one replaced letter changes nothing or moves one from a
   group to another. So near words lie in the same block or in one of a few known neighbours, of equal or adjacent length,
   and each pair of blocks meets once.
3. A block of many words is cut into parts of some ``PART`` words. A part's letter counts and those of a batch of words
   streaming past it give all squared distances in one NumPy product; pairs at most two apart are compared letter by letter.
4. Only sums go on: for each word how many near words were seen, and the most frequent of them.

No pair of words is stored, and no task holds more than a part and a batch.

Defined results: NULL and empty texts have no words; a NULL doc_id is written as nothing before the colon; repeated rows count
each; ties between near words go to the smaller in code-point order; words and texts of any length are taken whole; an empty
table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.rows import ASCII_UPPER
from cityweave.sources.scratch import durable

LEAST_LETTERS = 6
LEAST_COUNT = 5
FACTOR = 5
DAMAGE_EVERY = 199
GROUPS = 5
PART = 2_048
AT_ONCE = 4_096
HELD_WORDS = 200_000
TEXTS_AT_ONCE = 256
#: Lower-case letters and U+00C0 to U+00FF, dealt in turn to the groups.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


# --- words and how often they occur


def words_of(doc_id: int | None, text: str | None, least: int = LEAST_LETTERS) -> Counter:
    """The words of one document. A run keeps its spelling within a document, so each is looked at once."""
    runs = Counter()
    lower = str.maketrans(ASCII_UPPER, ASCII_UPPER.lower())
    for run, n in Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", text or "")).items():
        runs[run.translate(lower)] += n
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if h % DAMAGE_EVERY == 0:
            gone = h % len(run)
            run = run[:gone] + run[gone + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held.update(words_of(doc_id, text))
                if len(held) > HELD_WORDS:
                    yield flush()
                    held.clear()
    yield flush()


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """Columns word, n: the words that occur ``least`` times or more."""
    counted = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- blocks


def _group_counts(word: Column) -> list[Column]:
    groups = ["".join(LETTERS[g::GROUPS]) for g in range(GROUPS)]
    return [F.length(F.translate(word, "".join(h for h in groups if h != g), "")) for g in groups]


def _block(counts: list[Column], moves: tuple[int, ...] = (0,) * GROUPS) -> Column:
    return F.concat_ws(",", *[(c + m).cast("string") for c, m in zip(counts, moves)])


def _moves() -> list[tuple[int, ...]]:
    """From a word's counts to those of the blocks it is compared with, each pair of blocks in one direction only."""

    def move(*changes: tuple[int, int]) -> tuple[int, ...]:
        return tuple(sum(by for at, by in changes if at == g) for g in range(GROUPS))

    shorter = [move((i, -1)) for i in range(GROUPS)]
    replaced = [move((i, 1), (j, -1)) for i in range(GROUPS) for j in range(i + 1, GROUPS)]
    return shorter + replaced


def _dealt(words: DataFrame, part: int) -> DataFrame:
    """Every word once as a member of its part (side 0), once per other part of its block (1) and of neighbours (2)."""
    counts = [F.col(f"in_{g}") for g in range(GROUPS)]
    words = words.withColumns({f"in_{g}": c for g, c in enumerate(_group_counts(F.col("word")))})
    words = words.withColumn("home", _block(counts))
    blocks = words.groupBy("home").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    blocks = durable(blocks.withColumnRenamed("home", "block"), "word-blocks")
    near = F.explode(F.array(F.col("home"), *[_block(counts, m) for m in _moves()])).alias("block")
    spread = words.select("word", "n", "home", near).join(blocks, "block")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    spread = spread.withColumn("own", F.when(F.col("block") == F.col("home"), own))
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("own").isNull(), 2).when(F.col("own") == F.col("part"), 0).otherwise(1)
    return spread.select("block", "part", side.cast("int").alias("side"), "word", "n")


# --- distances


def letter_counts(words: list[str]) -> np.ndarray:
    """One row per word: how often each letter occurs."""
    place = np.zeros(256, np.int64)
    place[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.bincount(row * len(LETTERS) + place[codes], minlength=len(words) * len(LETTERS))
    return flat.reshape(len(words), len(LETTERS))


def _exact_type(longest: int) -> type:
    """All sums are halves of whole numbers below the square of the length, so they are exact."""
    return np.float32 if longest < 2_000 else np.float64


def close_pairs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of pairs at a squared distance of 1 or 2: one product gives half of all squared distances."""
    counts_a, counts_b = letter_counts(a), letter_counts(b)
    kind = _exact_type(max(map(len, a + b)))
    half_a, half_b = ((c.astype(np.float64) ** 2).sum(1, keepdims=True) / 2 for c in (counts_a, counts_b))
    left = np.hstack([counts_a, half_a, np.ones_like(half_a)]).astype(kind)
    right = np.hstack([-counts_b, np.ones_like(half_b), half_b]).astype(kind)
    half = left @ right.T
    i, j = np.nonzero(half <= 1)
    far = half[i, j] > 0
    return i[far], j[far]


def _codes(words: list[str], width: int) -> np.ndarray:
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def one_edit(a: list[str], b: list[str]) -> np.ndarray:
    """Whether the words of a pair, equally long or one apart, differ by exactly one code point."""
    width = max(map(len, a + b))
    short_first = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    x, y = (_codes([p[k] for p in short_first], width + 1) for k in (0, 1))
    n_short, n_long = (np.array([len(p[k]) for p in short_first]) for k in (0, 1))
    same = x == y
    replaced = (~same).sum(1) == 1
    ahead = np.cumprod(same, axis=1).sum(1)  # equal letters at the start, padding included
    shifted = np.zeros_like(same)
    shifted[:, :-1] = x[:, :-1] == y[:, 1:]
    inside = np.arange(width + 1) < n_short[:, None]
    # The longer word continues like the shorter one behind the inserted letter.
    differs = inside & ~shifted & (np.arange(width + 1) >= ahead[:, None])
    return np.where(n_short == n_long, replaced, ~differs.any(1))


def near_pairs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all near pairs between two lists. Distances and checks are made in slices of bounded size."""
    found = []
    for start in range(0, len(b), AT_ONCE):
        some = b[start : start + AT_ONCE]
        i, j = close_pairs(a, some)
        right = np.zeros(len(i), bool)
        step = max(1, (1 << 21) // (1 + max(map(len, a + some))))
        for at in range(0, len(i), step):
            s = slice(at, at + step)
            right[s] = one_edit([a[k] for k in i[s].tolist()], [some[k] for k in j[s].tolist()])
        found.append((i[right], j[right] + start))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class _Seen:
    """For the words of a list: number of near words, and the most frequent of them, ties to the smaller word."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = words, counts
        self.near: dict[int, list] = {}

    def add(self, mine: np.ndarray, others: np.ndarray, of: _Seen) -> None:
        for k, o in zip(mine.tolist(), others.tolist()):
            best = (-of.counts[o], of.words[o])
            held = self.near.get(k)
            if held is None:
                self.near[k] = [1, best]
            else:
                held[0] += 1
                if best < held[1]:
                    held[1] = best

    def batch(self) -> pa.RecordBatch:
        found = list(self.near.items())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.words[k] for k, _ in found], pa.string()),
                pa.array([v[0] for _, v in found], pa.int64()),
                pa.array([-v[1][0] for _, v in found], pa.int64()),
                pa.array([v[1][1] for _, v in found], pa.string()),
            ],
            names=["word", "n_near", "best_n", "best"],
        )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part and side: the members of a part, then all that are compared with them."""
    now, members, part = None, [], None

    def close_part():
        nonlocal part
        part = _Seen([w for w, _ in members], [n for _, n in members])
        pairs = near_pairs(part.words, part.words)
        part.add(*pairs, part)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("block", "part", "side", "word", "n")]
        ends = [k for k in range(1, batch.num_rows) if any(c[k] != c[k - 1] for c in columns[:3])]
        for at, end in zip([0, *ends], [*ends, batch.num_rows]):
            if end == at:
                continue
            place, side = (columns[0][at], columns[1][at]), columns[2][at]
            words, counts = columns[3][at:end], columns[4][at:end]
            if place != now:
                if members and part is None:
                    close_part()
                if part is not None:
                    yield part.batch()
                now, members, part = place, [], None
            if side == 0:
                members += zip(words, counts)
                continue
            if not members:
                continue
            if part is None:
                close_part()
            other = _Seen(words, counts)
            mine, theirs = near_pairs(part.words, words)
            part.add(mine, theirs, other)
            if side == 2:
                other.add(theirs, mine, part)
                yield other.batch()
    if members and part is None:
        close_part()
    if part is not None:
        yield part.batch()


def near_words(words: DataFrame, part: int = PART) -> DataFrame:
    """Columns word, n_near, best, best_n for the words (word, n) that have near words."""
    dealt = _dealt(words, part).repartition("block", "part").sortWithinPartitions("block", "part", "side")
    met = dealt.mapInArrow(_meet, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("first")
    return (
        met.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), first)
        .select("word", "n_near", F.col("first.word").alias("best"), (-F.col("first.n")).alias("best_n"))
    )


# --- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """From (word, form): word, root. Each step doubles the distance; counts grow along a chain, so chains are short."""
    current = durable(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = current.join(after, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        current = durable(moved, "roots")
        if not current.where("moved").limit(1).count():
            return current.select("word", "root")
        current = current.select("word", "root")


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    part: int = PART,
) -> DataFrame:
    """Columns word, form, root, n, n_near, form_n: each word of the corpus and the one it is a variant of."""
    words = durable(count_words(docs, key, text, least_count), "words")
    known = durable(words.join(near_words(words, part), "word", "left"), "near-words")
    is_form = F.col("best_n") >= factor * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    found = known.join(_roots(known.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
