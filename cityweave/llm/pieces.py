"""Sampled SentencePiece segmentation: forward filtering, backward sampling over the piece lattice.

A piece of id r weighs (r + 1) ** -theta, a segmentation the product of its pieces. Forward filtering adds up the
weights of all segmentations that end at each position; backward sampling then draws the last piece, the one
before it, and so on, so a segmentation comes out with exactly its share of the total weight. The random number for the piece
that ends at some place of a text is a hash of seed, row key and place: the same row is always cut the same way, wherever and
together with whatever else it runs.

Where no piece holds two neighbouring characters, no piece reaches across, and both sides are lattices of their own. Texts are
taken in slices of bounded size and cut there into chunks. The different chunks of one length are filtered together, and all
that occur are sampled together, step by step, in NumPy. Nothing is remembered from slice to slice. A long chunk is filtered in
blocks; of what lies before a block only the last sums are held, and the block is filtered again when it is sampled. A
character without a piece is written as its UTF-8 bytes. Decoding joins the pieces' bytes and gives back the very text, line
breaks and the space symbol included.

Defined results: NULL and empty texts have no pieces, and no pieces decode to an empty text; a NULL key
counts as one key of its own; equal rows are cut alike; texts and chunks of any length are cut whole; an empty table gives no
rows; extra columns play no part. The vocabulary file is read once on the driver, from a path that is a parameter; its pieces go
to the tasks with the function.
"""

from __future__ import annotations

import hashlib
import math
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 0.5
SEED = 13
SPACE = "▁"
#: All weights are multiplied by this per character, which is the same for every segmentation and keeps the sums in range.
LIFT = 6.0
#: Characters at once, the longest chunk that is filtered with others of its length, and the block of a longer one.
SLICE = 1 << 20
LONG = 32
BLOCK = 1 << 15
NONE = np.iinfo(np.int32).max
_PAIRS = 1 << 20
_SLOTS = 1 << 18
_GOLDEN = 0x9E3779B97F4A7C15


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, int, float]]  # with spaces for the space symbol; id and weight
    weights: list[float]  # by id
    byte_ids: list[int]
    text: list[bytes]  # by id
    mark: str  # of path and contents


def read_vocabulary(path: str = MODEL, theta: float = THETA) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weights, text, byte_ids = [], [], [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace(SPACE, " ")
        weights.append((i + 1.0) ** -theta)
        if model.is_byte(i):
            byte = int(piece[3:-1], 16)
            byte_ids[byte] = i
            text.append(bytes([byte]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            text.append(b"")
        else:
            pieces.append((piece, i, weights[i]))
            text.append(piece.encode())
    mark = hashlib.sha256(repr((path, theta, pieces)).encode()).hexdigest()
    return Vocabulary(pieces, weights, byte_ids, text, mark)


def key_draw(key: object, seed: int) -> int:
    """Where the random numbers of a row begin."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{key}".encode()).digest()[:8], "little")


def uniform(start: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) for places (from 1) of rows whose numbers begin at ``start``."""
    z = start + place.astype(np.uint64) * np.uint64(_GOLDEN)
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((z ^ z >> np.uint64(31)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Lattice(NamedTuple):
    """Different chunks of one length: per chunk, end and length of the last piece the running sum of masses, and its id."""

    sums: np.ndarray
    ids: np.ndarray


class Sampler:
    """Draws segmentations. Holds the vocabulary as a tree of characters whose edges are found by hash."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        letters = sorted({c for p, _, _ in vocabulary.pieces for c in p})
        place = {c: i for i, c in enumerate(letters, 1)}
        self.letter = np.zeros(0x110000, np.int64)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.n_letters = len(letters) + 1
        edges: dict[int, int] = {}
        piece = [-1]
        neighbours = set()
        for text, i, _ in vocabulary.pieces:
            node = 0
            for c in text:
                node = edges.setdefault(node * self.n_letters + place[c], len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = i
            neighbours.update((place[a], place[b]) for a, b in zip(text, text[1:]))
        self.piece = np.array(piece, np.int32)
        self.longest = max(len(p) for p, _, _ in vocabulary.pieces)
        self.weight = np.array(vocabulary.weights)
        self.slot_key = np.full(_SLOTS, -1, np.int64)
        self.slot_node = np.zeros(_SLOTS, np.int64)
        keys = np.fromiter(edges, np.int64, len(edges))
        for key, node, slot in zip(edges, edges.values(), self._slot(keys).tolist()):
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) % _SLOTS
            self.slot_key[slot], self.slot_node[slot] = key, node
        pairs = np.array(sorted(neighbours), np.int64).reshape(-1, 2)
        # Different pairs may share a place here: then a text stays uncut there, which changes nothing.
        self.joined = np.zeros(_PAIRS, bool)
        self.joined[self._pair(pairs[:, 0], pairs[:, 1])] = True
        self.spellings: dict[int, tuple[list[int], float]] = {}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(_GOLDEN) >> np.uint64(64 - 18)).astype(np.int64)

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 40_503 + b) & (_PAIRS - 1)

    def children(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The node behind each edge, 0 where there is none."""
        keys = nodes * self.n_letters + letters
        slots = self._slot(keys)
        there = self.slot_key[slots]
        out = np.where(there == keys, self.slot_node[slots], 0)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while open_.size:
            slots[open_] = (slots[open_] + 1) % _SLOTS
            there = self.slot_key[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.slot_node[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def matches(self, letters: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and id of every piece in a text of letters, none going beyond ``ends`` of its start."""
        at = np.arange(len(letters))
        node = np.zeros(len(letters), np.int64)
        starts, lengths, ids = [], [], []
        for length in range(1, self.longest + 1):
            node = self.children(node, letters[at + length - 1])
            found = self.piece[node]
            hit = found >= 0
            starts.append(at[hit])
            lengths.append(np.full(starts[-1].size, length))
            ids.append(found[hit])
            on = (node > 0) & (at + length < ends[at])
            at, node = at[on], node[on]
            if not at.size:
                break
        return np.concatenate(starts), np.concatenate(lengths), np.concatenate(ids)

    def spell(self, code: int) -> tuple[list[int], float]:
        """The bytes of a character without a piece, and their weight."""
        if code not in self.spellings:
            if len(self.spellings) > 10_000:
                self.spellings.clear()
            ids = [self.vocabulary.byte_ids[b] for b in chr(code).encode("utf-8", "surrogatepass")]
            self.spellings[code] = ids, LIFT * math.prod(self.vocabulary.weights[i] for i in ids)
        return self.spellings[code]

    def filter(self, chunks: np.ndarray) -> Lattice:
        """Forward filtering of chunks of one length, given as rows of code points."""
        n, size = chunks.shape
        most = min(size, self.longest)
        sums, ids = np.zeros((n, size, most)), np.full((n, size, most), NONE, np.int32)
        flat = chunks.ravel()
        starts, lengths, found = self.matches(self.letter[flat], np.repeat(np.arange(1, n + 1) * size, size))
        row, end = starts // size, starts % size + lengths - 1
        sums[row, end, lengths - 1] = self.weight[found] * LIFT**lengths
        ids[row, end, lengths - 1] = found
        row, end = np.nonzero(sums[:, :, 0] == 0)
        codes = chunks[row, end]
        ids[row, end, 0] = -1 - codes.astype(np.int64)
        for code in np.unique(codes).tolist():
            mine = codes == code
            sums[row[mine], end[mine], 0] = self.spell(code)[1]
        total = np.ones((n, size + 1))
        for e in range(size):
            k = min(e + 1, most)
            mass = sums[:, e, :k] * total[:, e + 1 - k : e + 1][:, ::-1]
            sums[:, e, :k] = np.cumsum(mass, axis=1)
            sums[:, e, k:] = sums[:, e, k - 1 : k]
            total[:, e + 1] = sums[:, e, k - 1]
        return Lattice(sums, ids)

    @staticmethod
    def sample(lattice: Lattice, which, first, begin, place, out) -> None:
        """Backward sampling of chunks: ``which`` of the lattice, where it stands in ``out`` and, with its row, in its text."""
        size = lattice.sums.shape[1]
        at = np.full(len(which), size)
        while at.size:
            sums = lattice.sums[which, at - 1]
            goal = uniform(begin, place + at) * sums[:, -1]
            back = (sums <= goal[:, None]).sum(1)
            out[first + at - 1] = lattice.ids[which, at - 1, back]
            at = at - back - 1
            on = at > 0
            if not on.all():
                at, which, first, begin, place = at[on], which[on], first[on], begin[on], place[on]

    def _block(self, codes: np.ndarray, low: int, high: int, total: list[float]) -> tuple[list, list, list[float]]:
        """Filters the ends low + 1 to high of a long chunk, from the sums of the last ends up to low (which are ``total``)."""
        first = max(0, low + 1 - self.longest)
        part = codes[first:high]
        starts, lengths, found = self.matches(self.letter[part], np.full(len(part), len(part)))
        ends = starts + lengths + first
        by_end: list[list] = [[] for _ in range(high - low)]
        weights = self.weight[found] * LIFT**lengths
        for end, length, i, weight in zip(ends.tolist(), lengths.tolist(), found.tolist(), weights.tolist()):
            if end > low:
                by_end[end - low - 1].append((length, i, weight))
        total = list(total)
        masses = []
        for end, options in enumerate(by_end, low + 1):
            if not any(length == 1 for length, _, _ in options):
                code = int(codes[end - 1])
                options.insert(0, (1, -1 - code, self.spell(code)[1]))
            run, sums = 0.0, []
            for length, _, weight in options:
                run += total[-length] * weight
                sums.append(run)
            masses.append(sums)
            total.append(run)
            if not 1e-60 < run < 1e60:
                total[-self.longest :] = [t / run for t in total[-self.longest :]]
        return by_end, masses, total[-self.longest :]

    def sample_long(self, codes: np.ndarray, begin: int, place: int, out: np.ndarray) -> None:
        """The same for one long chunk, block by block."""
        size = len(codes)
        lows, held, total = range(0, size, BLOCK), [], [1.0]
        for low in lows:
            held.append(total)
            total = self._block(codes, low, min(low + BLOCK, size), total)[2]
        at = size
        for low, total in zip(reversed(lows), reversed(held)):
            if at <= low:
                continue
            high = min(low + BLOCK, size)
            by_end, masses, _ = self._block(codes, low, high, total)
            draws = uniform(np.uint64(begin), np.arange(place + low + 1, place + high + 1))
            while at > low:
                sums, options = masses[at - low - 1], by_end[at - low - 1]
                goal = draws[at - low - 1] * sums[-1]
                length, i, _ = next((o for s, o in zip(sums, options) if s > goal), options[-1])
                out[at - 1] = i
                at -= length

    def encode_slice(self, parts: list[np.ndarray], begins: list[int], places: list[int]) -> list[np.ndarray]:
        """Pieces of parts of texts, each with the begin of its row's numbers and how many characters stand before it."""
        codes = np.concatenate(parts)
        bounds = np.cumsum([0, *map(len, parts)])
        letters = self.letter[codes]
        new = np.ones(len(codes), bool)
        new[1:] = ~self.joined[self._pair(letters[:-1], letters[1:])]
        new[bounds[:-1]] = True
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=len(codes))
        part = np.searchsorted(bounds, starts, "right") - 1
        begin, place = np.array(begins, np.uint64)[part], np.array(places, np.int64)[part] + starts - bounds[part]
        out = np.full(len(codes), NONE, np.int32)
        for size in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == size)
            if size > LONG:
                for k in mine.tolist():
                    s = slice(starts[k], starts[k] + size)
                    self.sample_long(codes[s], int(begin[k]), int(place[k]), out[s])
                continue
            chunks = codes[starts[mine, None] + np.arange(size)]
            first, which = different(chunks)
            self.sample(self.filter(chunks[first]), which, starts[mine], begin[mine], place[mine], out)
        return self._pieces(out, bounds)

    def _pieces(self, out: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """What stands at the ends of pieces, by part, with spelled characters written out."""
        there = out != NONE
        ends = np.concatenate([[0], np.cumsum(there)])[bounds]
        ids = out[there]
        spelled = np.flatnonzero(ids < 0)
        if spelled.size:
            times = np.ones(len(ids), np.int64)
            times[spelled] = [len(self.spell(-1 - i)[0]) for i in ids[spelled].tolist()]
            to = np.concatenate([[0], np.cumsum(times)])
            wide = np.repeat(ids, times)
            for k in spelled.tolist():
                wide[to[k] : to[k + 1]] = self.spell(-1 - int(ids[k]))[0]
            ids, ends = wide, to[ends]
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def parts_of(self, text: str | None) -> Iterator[tuple[np.ndarray, int]]:
        """A text in parts of about a slice, cut only where no piece reaches across, with the characters before each."""
        if not text:
            return
        codes, at = code_points(" " + text), 0
        while len(codes) - at > SLICE:
            end, step = at + SLICE, 64
            while end < len(codes):
                letters = self.letter[codes[end - 1 : end + step]]
                free = np.flatnonzero(~self.joined[self._pair(letters[:-1], letters[1:])])
                if free.size:
                    end += int(free[0])
                    break
                end, step = end + step, min(2 * step, SLICE)
            end = min(end, len(codes))
            yield codes[at:end], at
            at = end
        if at < len(codes):
            yield codes[at:], at

    def encode_rows(self, texts: list[str | None], begins: list[int]) -> list[np.ndarray]:
        """The pieces of each text, slice by slice."""
        rows: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, np.ndarray, int]] = []
        n = 0

        def run() -> None:
            if waiting:
                cut = self.encode_slice([p for _, p, _ in waiting], [begins[r] for r, _, _ in waiting], [a for _, _, a in waiting])
                for (r, _, _), ids in zip(waiting, cut):
                    rows[r].append(ids)
                waiting.clear()

        for r, text in enumerate(texts):
            for part, at in self.parts_of(text):
                waiting.append((r, part, at))
                n += len(part)
                if n >= SLICE:
                    run()
                    n = 0
        run()
        return [ids[0] if len(ids) == 1 else np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32) for ids in rows]

    def encode(self, text: str | None, begin: int) -> list[int]:
        return self.encode_rows([text], [begin])[0].tolist()


def different(chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each kind of equal rows, and for each row its kind. Found by hash, then compared."""
    factor = np.uint64(_GOLDEN)
    while True:
        mixed = np.zeros(len(chunks), np.uint64)
        for k in range(chunks.shape[1]):
            mixed = (mixed + chunks[:, k]) * factor
            mixed ^= mixed >> np.uint64(29)
        _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
        if (chunks[first[which]] == chunks).all():
            return first, which
        factor += np.uint64(2)


def sampler_of_this_worker(vocabulary: Vocabulary) -> Sampler:
    """One sampler per worker process, so a task need not build its own. Results do not depend on it."""
    place = sys.modules.setdefault("sampler_of_this_worker", types.ModuleType("sampler_of_this_worker"))
    if getattr(place, "mark", None) != vocabulary.mark:
        place.mark, place.sampler = vocabulary.mark, Sampler(vocabulary)
    return place.sampler


def decode(ids, vocabulary: Vocabulary) -> str:
    text = vocabulary.text
    return b"".join([text[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


def encode_column(text: Column, key: Column, vocabulary: Vocabulary, seed: int = SEED) -> Column:
    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sampler = sampler_of_this_worker(vocabulary)
        for texts, keys in batches:
            yield pd.Series(sampler.encode_rows(texts.tolist(), [key_draw(k, seed) for k in keys]), dtype=object)

    # Keys come as text, as a column of numbers with NULL in it would turn into floats.
    return encoded(text, key.cast("string"))


def decode_column(ids: Column, vocabulary: Vocabulary) -> Column:
    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if ids is None else decode(ids.tolist(), vocabulary) for ids in rows], dtype=object)

    return decoded(ids)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about a slice of text, so that what a part needs is bounded whatever the session's batch size."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start, n = 0, 0
    for k, s in enumerate(size.tolist()):
        n += s
        if n >= SLICE:
            yield batch.slice(start, k + 1 - start)
            start, n = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _both_ways(vocabulary: Vocabulary, seed: int, whole: bool):
    """Encodes, and decodes again in the same worker: with the texts if ``whole``, else whether they came out the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = sampler_of_this_worker(vocabulary)
        for batch in batches:
            for part in _slices(batch):
                texts = part.column("text").to_pylist()
                keys = part.column("doc_id").to_pylist()
                cut = sampler.encode_rows(texts, [key_draw(k, seed) for k in keys])
                back = [decode(ids.tolist(), vocabulary) for ids in cut]
                ends = np.cumsum([0, *map(len, cut)]).astype(np.int32)
                pieces = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(cut)))
                columns = {"doc_id": part.column("doc_id"), "pieces": pieces}
                if whole:
                    columns |= {"text": part.column("text"), "decoded": pa.array(back, pa.string())}
                else:
                    columns["n_chars"] = pa.array([len(t or "") for t in texts], pa.int64())
                    columns["lossless"] = pa.array([(t or "") == b for t, b in zip(texts, back)], pa.bool_())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _cut(docs: DataFrame, model: str, theta: float, seed: int, whole: bool) -> DataFrame:
    vocabulary = read_vocabulary(model, theta)
    rest = "text string, decoded string" if whole else "n_chars long, lossless boolean"
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_both_ways(vocabulary, seed, whole), f"doc_id {kind}, pieces array<int>, {rest}")


def segment(docs: DataFrame, model: str = MODEL, theta: float = THETA, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, text, pieces (ids), decoded (the text again)."""
    return _cut(docs, model, theta, seed, True).select("doc_id", "text", "pieces", "decoded")


def digests(docs: DataFrame, model: str = MODEL, theta: float = THETA, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_chars, n_pieces, pieces_hash, lossless, pieces."""
    return _cut(docs, model, theta, seed, False).select(
        "doc_id",
        "n_chars",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        "lossless",
        "pieces",
    )
