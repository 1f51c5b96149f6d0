"""Quality rules: bands of zstandard ratios, beside plain counts.

The ratio is compressed bytes / bytes. The whole text and each chunk of ``CHUNK`` bytes are compressed; each ratio must lie in
the band of its length, as short texts compress less. A text goes if its own ratio lies outside, or those of more than
``BAD_CHUNKS`` of its chunks: repetitive below the band, incompressible above it.

``fit_bands`` takes the bands from texts labelled as good: per half octave of length the quantiles ``TAIL`` and 1 - ``TAIL`` of
their ratios, widened by ``MARGIN``. All labelled documents are read for it. Where a length has fewer than ``EXAMPLES`` of them, and without labels, the wide ``BANDS`` hold, whose ceilings lie
between prose and base64.

Defined results: NULL and blank texts have no words and fail the base rules; a last chunk shorter than half a chunk
counts with the one before it; texts of any length are compressed whole; repeated rows are judged alike; an empty table gives
no rows; extra columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.rows import bound_batches

LEVEL = 3
CHUNK = 1024
#: (bytes up to, least ratio, largest ratio)
BANDS = (
    (256, 0.30, 0.95), (512, 0.30, 0.80), (1024, 0.22, 0.74), (2048, 0.22, 0.68), (4096, 0.16, 0.64), (8192, 0.16, 0.61),
    (float("inf"), 0.10, 0.60),
)
BAD_CHUNKS = 0.2
TAIL = 0.005
MARGIN = 0.01
EXAMPLES = 30
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
KIND = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, bad_chunks double, kept boolean"
)


#: From half octave of length to least and largest ratio.
Bands = dict[int, tuple[float, float]]


class Judged(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    ratio: float | None
    bad_chunks: float | None
    kept: bool


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def chunks_of(raw: bytes, size: int) -> list[bytes]:
    cuts = list(range(0, len(raw), size)) or [0]
    if len(cuts) > 1 and len(raw) - cuts[-1] < size // 2:
        cuts.pop()
    return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])]


def half_octave(n_bytes: int) -> int:
    """2, 3, 4, ... from 2, 2.8, 4, ... bytes on."""
    return (n_bytes * n_bytes).bit_length() - 1


def band_of(n_bytes: int, bands: Bands | None) -> tuple[float, float]:
    fitted = bands and bands.get(half_octave(n_bytes))
    return fitted or next((low, high) for up_to, low, high in BANDS if n_bytes <= up_to)


def in_bands(raw: bytes, compress, bands: Bands | None = None) -> tuple[float, float, bool]:
    def ratio_of(part: bytes) -> tuple[float, bool]:
        ratio = len(compress(part)) / len(part)
        low, high = band_of(len(part), bands)
        return ratio, low <= ratio <= high

    ratio, fine = ratio_of(raw)
    chunks = chunks_of(raw, CHUNK)
    bad = sum(not ratio_of(c)[1] for c in chunks) / len(chunks) if len(chunks) > 1 else float(not fine)
    return ratio, bad, fine and bad <= BAD_CHUNKS


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def whole_ratio(text: str | None, compress) -> float | None:
    """Ratio of the whole text if it passes the base rules."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # at the six ASCII white-space characters
    return None if fails_base(len(words), repeated_words(words)) else len(compress(raw)) / len(raw)


def judge_text(text: str | None, compress, bands: Bands | None = None) -> Judged:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at the six ASCII white-space characters
    base = (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(words),
    )
    ratio, bad, fine = in_bands(raw, compress, bands) if raw else (None, None, False)
    return Judged(*base, ratio, bad, fine and not fails_base(len(words), base[4]))


def _with_judgement(docs: DataFrame, bands: Bands | None) -> DataFrame:
    """doc_id, size (bytes), j (``Judged``), base_failed."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf(KIND)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for texts in batches:
            yield pd.DataFrame([judge_text(t, compress, bands) for t in texts], columns=Judged._fields)

    failed = (F.col("j.n_words") < LEAST_WORDS) | (
        100 * F.col("j.n_repeat_words") > MOST_REPEATED * F.col("j.n_words")
    )
    size = F.octet_length("text").cast("long").alias("size")
    return docs.select("doc_id", size, judged("text").alias("j")).withColumn("base_failed", failed)


def _ratios(docs: DataFrame) -> DataFrame:
    """doc_id, size (bytes) and ratio of the whole text, of texts that pass the base rules."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def ratio(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for texts in batches:
            yield pd.Series([whole_ratio(t, compress) for t in texts], dtype="float64")

    size = F.octet_length("text").cast("long").alias("size")
    return docs.select("doc_id", size, ratio("text").alias("ratio")).where("ratio is not null and not isnan(ratio)")


def fit_bands(docs: DataFrame, labels: DataFrame) -> Bands:
    """Bands by half octave of length, from all good documents that pass the base rules."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    # Numbers and not texts are shuffled, however many labels there are.
    facts = _ratios(docs).join(good, "doc_id", "left_semi")
    # The square of a size of up to 2^31 is a long.
    octave = F.length(F.conv((F.col("size") * F.col("size")).cast("string"), 10, 2)) - 1
    ends = F.percentile_approx("ratio", [TAIL, 1 - TAIL], 10_000)
    by_length = facts.groupBy(octave.alias("octave")).agg(F.count("*").alias("n"), ends.alias("ends"))
    # One row per half octave, some sixty at most.
    return {r.octave: (r.ends[0] - MARGIN, r.ends[1] + MARGIN) for r in by_length.where(F.col("n") >= EXAMPLES).collect()}


def judge(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, ratio, bad_chunks."""
    counts = [f"j.{c}" for c in Judged._fields[:5]]
    return _with_judgement(docs, bands).select("doc_id", *counts, "base_failed", "j.kept", "j.ratio", "j.bad_chunks")
