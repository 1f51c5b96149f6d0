"""Damage to conversations and its cheapest repair, with whole numbers as path weights.

A repair is a path through a graph whose nodes are (row, roles so far): each edit keeps, reroles, deletes or inserts a row. The
weight of an edit is one whole number. Its high digits are the cost. Below them are as many octal digits as an audit can have
letters; the edit's letter stands at its place in the audit, and what comes behind is zero. So sums of weights compare
first by cost and then as the audits do, a shorter one before what continues it, and the least number decides everything.

Two paths of equal cost to the same node never have audits of which one begins the other (they would differ by
insertions only, which cost). Therefore the least number to a node is part of the least number overall, also when a
conversation is cut: a segment gives the least path from each state to each state, and these are chained.

Conversations are dealt by conv_id and repaired in one pass over sorted rows. Those of more than ``LONG_ROWS`` rows or ``LONG_BYTES``
bytes take another way with the same result: rows are dealt by range, so they spread over many tasks, segments are solved apart,
and only the segments' tables are chained per conversation. Its digest, which can only be taken in order, is then taken from a
sorted stream that holds one batch.

Defined results: a NULL in any column counts as one space, in the key of the damage, as role and as text; a NULL conv_id is a
conversation of its own; rows are taken by turn, NULL first, ties by role and text, so equal rows are interchangeable; repeated
rows are rows of their own; texts of any length are read whole; gaps beyond the range of a long are NULL; an empty table gives
no rows; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.sources.scratch import durable

FAULTS = 20
LONG_ROWS = 4_096
LONG_BYTES = 8 << 20
SEGMENT = 512
AT_ONCE = 512
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
#: The letters of an audit in ASCII order, as octal digits; 0 is no letter.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
BITS = 3
#: Roles so far: none, system only, a user last, an assistant last. What may follow each, and what an inserted row is there.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
ENDS = (START, ASSISTANT)
#: Three insertions in a row come back to the state after one.
MOST_INSERTED = 2
LEGAL = {"su", "ua", "au"}
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
WHITE = " \t\n\x0b\x0c\r"


class Mark(NamedTuple):
    """What the repair needs of a row."""

    initial: str
    bad: bool  # blank or duplicate: must go
    truncated: bool


class Path(NamedTuple):
    weight: int
    letters: int


# --- paths


def _weight(letter: str, extra: int, at: int, width: int) -> int:
    """An edit at place ``at`` of an audit of at most ``width`` letters."""
    return (COSTS[letter] + extra << BITS * width) + (DIGITS[letter] << BITS * (width - 1 - at))


def _extend(paths: dict[int, Path], state: int, path: Path, letter: str, extra: int, width: int) -> None:
    weight = path.weight + _weight(letter, extra, path.letters, width)
    held = paths.get(state)
    if held is None or weight < held.weight:
        paths[state] = Path(weight, path.letters + 1)


def _inserted(paths: dict[int, Path], width: int) -> dict[int, Path]:
    """Paths with insertions behind them where that is cheaper."""
    paths = dict(paths)
    for _ in range(MOST_INSERTED):
        for state, path in list(paths.items()):
            _extend(paths, FOLLOWS[state][WANTED[state][0]], path, "I", 0, width)
    return paths


def _walk(paths: dict[int, Path], marks: Iterable[Mark], width: int) -> dict[int, Path]:
    """The least path to each state behind the rows, each with insertions before it."""
    for mark in marks:
        after: dict[int, Path] = {}
        for state, path in _inserted(paths, width).items():
            _extend(after, state, path, "D", 0, width)
            if mark.bad:
                continue
            follows = FOLLOWS[state]
            if mark.initial in follows:
                _extend(after, follows[mark.initial], path, "K", mark.truncated, width)
            _extend(after, follows[WANTED[state][0]], path, "R", mark.truncated, width)
        paths = after
    return paths


def _ended(paths: dict[int, Path], width: int) -> Path:
    paths = _inserted(paths, width)
    return min((paths[s] for s in ENDS if s in paths), key=lambda p: p.weight)


def _read(path: Path, width: int) -> tuple[int, str]:
    """Cost and audit of a path."""
    audit = format(path.weight & (1 << BITS * width) - 1, f"0{width}o")[: path.letters]
    return path.weight >> BITS * width, audit.translate({ord(str(d)): letter for letter, d in DIGITS.items()})


def _digits(audit: str) -> int:
    return int(audit.translate({ord(letter): str(d) for letter, d in DIGITS.items()}) or "0", 8)


def cheapest(marks: list[Mark]) -> tuple[int, str]:
    """Cost and audit of the repair of a whole conversation."""
    width = 2 * len(marks) + MOST_INSERTED
    return _read(_ended(_walk({START: Path(0, 0)}, marks, width), width), width)


def repaired(state: int, rows: Iterable[tuple[str, str]], audit: str) -> Iterator[str]:
    """The lines that an audit makes of rows (role, text), from a state on."""
    rows = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = WANTED[state]
        state = FOLLOWS[state][role[0]]
        yield f"{role}:{text}"


# --- rows


def marks_of(rows: list[tuple[str, str]]) -> tuple[list[Mark], dict[str, int]]:
    """Marks of rows (role, text), and how many are blank, duplicate or truncated and how many neighbours illegal."""
    marks, seen = [], set()
    n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        blank, again = not last, (role, text) in seen
        cut_off = not blank and not again and last not in ".!?"
        seen.add((role, text))
        n["blank"] += blank
        n["duplicate"] += again and not blank
        n["truncated"] += cut_off
        marks.append(Mark(role[:1], blank or again, cut_off))
    n["illegal"] = sum(a.initial + b.initial not in LEGAL for a, b in zip(marks, marks[1:]))
    return marks, n


def gaps_of(turns: Iterable[int | None]) -> int | None:
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return gaps if gaps < 1 << 63 else None


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after damage. Rows that it drops stay as ``gone``, so no conversation is lost."""

    def known(name: str):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    rows = rows.select("conv_id", "turn", "role", "text")
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % FAULTS
    unended = F.regexp_replace(known("text"), "[.!?]", "")
    text = F.when(F.col("fault") < 2, "").when(F.col("fault") == 2, unended).otherwise(known("text"))
    damaged = rows.withColumn("fault", fault).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("fault") == 4, "user").otherwise(known("role")).alias("role"),
        text.alias("text"),
        (F.col("fault") == 0).alias("gone"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("times"),
    )
    return damaged.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


# --- conversations that fit into a task


def _repair_runs(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def result(conv_id, run: list[tuple]) -> dict:
        there = [(role, text) for _, role, text, gone in run if not gone]
        marks, n = marks_of(there)
        cost, audit = cheapest(marks)
        lines = "\n".join(repaired(START, there, audit))
        return {
            "conv_id": conv_id,
            "gaps": gaps_of(turn for turn, _, _, gone in run if not gone),
            **n,
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256(lines.encode("utf-8", "surrogatepass")).hexdigest(),
        }

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, run, done = None, [], []
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                columns = [part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")]
                for conv_id, *row in zip(*columns):
                    if run and conv_id != now:
                        done.append(result(now, run))
                        run = []
                    now = conv_id
                    run.append(tuple(row))
                if len(done) >= AT_ONCE:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done = []
        if run:
            done.append(result(now, run))
        yield pa.RecordBatch.from_pylist(done, schema)

    return repair


# --- long conversations


def _long_rows(damaged: DataFrame) -> DataFrame:
    """Rows of long conversations in order: ``pos`` grows along a conversation; written, so that it stays."""
    ordered = damaged.where("not gone").withColumn("start", F.substring("text", 1, 64))
    order = ["conv_id", "turn", "role", "text", "nth"]
    ordered = ordered.repartitionByRange("conv_id", "turn", "role", "start").sortWithinPartitions(*order)
    return durable(ordered.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "long-rows")


def _marked(rows: DataFrame, segment: int) -> DataFrame:
    """conv_id, seg, pos and what a row is; the first of equal rows of a conversation is the one with the least ``pos``."""
    same = ["conv_id", "role", F.sha2("text", 256).alias("digest")]
    first = durable(rows.groupBy(*same).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first")), "first-rows")
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    blank = last == ""
    again = F.col("first").isNull()
    return rows.join(first, "pos", "left").select(
        "conv_id",
        F.floor(F.col("pos") / segment).alias("seg"),
        "pos",
        F.substring("role", 1, 1).alias("initial"),
        blank.alias("blank"),
        (again & ~blank).alias("duplicate"),
        (~blank & ~again & ~last.isin(".", "!", "?")).alias("truncated"),
    )


_SEGMENT_ROW = (
    "conv_id {id}, seg long, n long, blank long, duplicate long, truncated long, illegal long, initials string, "
    "paths array<struct<start:int,end:int,cost:long,audit:string>>"
)


def _solve_segment(table: pa.Table) -> pa.Table:
    """The least path from each state to each state behind the rows of one segment."""
    rows = sorted(table.to_pylist(), key=lambda r: r["pos"])
    marks = [Mark(r["initial"], r["blank"] or r["duplicate"], r["truncated"]) for r in rows]
    width = 2 * len(marks) + MOST_INSERTED
    paths = []
    for start in FOLLOWS:
        for end, path in _walk({start: Path(0, 0)}, marks, width).items():
            cost, audit = _read(path, width)
            paths.append({"start": start, "end": end, "cost": cost, "audit": audit})
    out = {
        "conv_id": [rows[0]["conv_id"]],
        "seg": [rows[0]["seg"]],
        "n": [len(rows)],
        **{c: [sum(r[c] for r in rows)] for c in ("blank", "duplicate", "truncated")},
        "illegal": [sum(a.initial + b.initial not in LEGAL for a, b in zip(marks, marks[1:]))],
        # Empty initials are written as a digit, so that first and last keep their places.
        "initials": [(marks[0].initial or "0") + (marks[-1].initial or "0")],
        "paths": [paths],
    }
    schema = pa.schema(
        [
            ("conv_id", table.schema.field("conv_id").type),
            *[(c, pa.int64()) for c in ("seg", "n", "blank", "duplicate", "truncated", "illegal")],
            ("initials", pa.string()),
            ("paths", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        ]
    )
    return pa.table(out, schema)


def _chain_segments(table: pa.Table) -> pa.Table:
    """One conversation: the least path through its segments, as the audit of each and the sums over all."""
    segments = sorted(table.to_pylist(), key=lambda r: r["seg"])
    width = 2 * sum(s["n"] for s in segments) + MOST_INSERTED
    paths = {START: (Path(0, 0), ())}
    for segment in segments:
        after: dict[int, tuple[Path, tuple]] = {}
        for piece in segment["paths"]:
            if piece["start"] not in paths:
                continue
            path, before = paths[piece["start"]]
            letters = path.letters + len(piece["audit"])
            weight = path.weight + (piece["cost"] << BITS * width) + (_digits(piece["audit"]) << BITS * (width - letters))
            held = after.get(piece["end"])
            if held is None or weight < held[0].weight:
                after[piece["end"]] = (Path(weight, letters), (before, piece["start"], piece["audit"]))
        paths = after
    best = _ended({state: path for state, (path, _) in paths.items()}, width)
    cost, audit = _read(best, width)
    # The path that was extended is the one whose audit begins the result; insertions may follow it.
    path, trace = min((p for p in paths.values() if audit.startswith(_read(p[0], width)[1])), key=lambda p: p[0].weight)
    pieces = []
    tail = audit[path.letters :]
    while trace:
        trace, start, piece = trace
        pieces.append((start, piece))
    pieces.reverse()
    pieces[-1] = (pieces[-1][0], pieces[-1][1] + tail)
    ends = [s["initials"] for s in segments]
    totals = {c: sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated", "illegal")}
    totals["illegal"] += sum(a[1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:]))
    first = [True] + [False] * (len(segments) - 1)
    columns = {
        "conv_id": pa.array([s["conv_id"] for s in segments], table.schema.field("conv_id").type),
        "seg": pa.array([s["seg"] for s in segments], pa.int64()),
        "start": pa.array([p[0] for p in pieces], pa.int32()),
        "piece": pa.array([p[1] for p in pieces], pa.string()),
        "first": pa.array(first, pa.bool_()),
        **{c: pa.array([n] * len(segments), pa.int64()) for c, n in totals.items()},
        "cost": pa.array([cost] * len(segments), pa.int64()),
        "audit": pa.array([audit if f else None for f in first], pa.string()),
    }
    return pa.table(columns)


def _digest_runs(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per conversation the SHA-256 of its repaired lines, from rows sorted by pos, each with the audit of its segment."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, segment, held, lines, sha, any_line = None, None, [], None, None, False

        def finish_segment():
            nonlocal held, any_line
            if segment is not None:
                for line in repaired(segment[1], held, segment[2]):
                    sha.update((("\n" if any_line else "") + line).encode("utf-8", "surrogatepass"))
                    any_line = True
            held = []

        def out():
            return pa.RecordBatch.from_pylist([{"conv_id": now, "repaired_sha256": sha.hexdigest()}], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                names = ("conv_id", "seg", "start", "piece", "role", "text")
                for conv_id, seg, start, piece, role, text in zip(*[part.column(c).to_pylist() for c in names]):
                    if sha is None or conv_id != now:
                        if sha is not None:
                            finish_segment()
                            yield out()
                        now, segment, sha, any_line = conv_id, None, hashlib.sha256(), False
                    if segment is None or seg != segment[0]:
                        finish_segment()
                        segment = (seg, start, piece)
                    held.append((role, text))
        if sha is not None:
            finish_segment()
            yield out()

    return digest


def _repair_long(damaged: DataFrame, segment: int) -> DataFrame:
    kind = damaged.schema["conv_id"].dataType.simpleString()
    rows = _long_rows(damaged)
    marked = _marked(rows, segment)
    solved = marked.groupBy("conv_id", "seg").applyInArrow(_solve_segment, _SEGMENT_ROW.format(id=kind))
    chained = durable(
        solved.groupBy("conv_id").applyInArrow(
            _chain_segments,
            f"conv_id {kind}, seg long, start int, piece string, first boolean, blank long, duplicate long, truncated long, "
            "illegal long, cost long, audit string",
        ),
        "long-repairs",
    )
    turns = rows.groupBy("conv_id").agg(
        F.max("turn").cast("decimal(20)").alias("hi"),
        F.min("turn").cast("decimal(20)").alias("lo"),
        F.count_distinct("turn").alias("different"),
    )
    gaps = F.when(F.col("hi").isNull(), 0).otherwise((F.col("hi") - F.col("lo") + 1 - F.col("different")).try_cast("long"))
    turns = durable(turns.select(F.col("conv_id").alias("id"), gaps.alias("gaps")), "long-gaps")
    placed = rows.withColumn("seg", F.floor(F.col("pos") / segment)).alias("r")
    choice = chained.select(F.col("conv_id").alias("id"), F.col("seg").alias("of"), "start", "piece")
    met = placed.join(choice, F.col("r.conv_id").eqNullSafe(F.col("id")) & (F.col("seg") == F.col("of")))
    met = met.select("conv_id", "pos", "seg", "start", "piece", "role", "text")
    met = met.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    names = pa.schema([("conv_id", _arrow(kind)), ("repaired_sha256", pa.string())])
    digests = met.mapInArrow(_digest_runs(names), f"conv_id {kind}, repaired_sha256 string")
    digests = durable(digests.withColumnRenamed("conv_id", "of_id"), "long-digests")
    out = chained.where("first").join(turns, F.col("conv_id").eqNullSafe(F.col("id")))
    out = out.join(digests, F.col("conv_id").eqNullSafe(F.col("of_id")))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


# --- all conversations


def _arrow(kind: str) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())


def repair(
    conversations: DataFrame,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
    segment: int = SEGMENT,
) -> DataFrame:
    """One row per conversation: conv_id, its faults after damage, and cost, audit and digest of its cheapest repair."""
    damaged = damage(conversations)
    kind = damaged.schema["conv_id"].dataType.simpleString()
    there = F.when(~F.col("gone"), F.octet_length("text").cast("long"))
    sizes = damaged.groupBy("conv_id").agg(F.count(there).alias("n"), F.sum(there).alias("bytes"))
    long_ones = sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes))
    long_ones = durable(long_ones.select(F.col("conv_id").alias("long_id")), "long-conversations")
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    any_long = long_ones.limit(1).count() > 0
    short = damaged.join(long_ones, is_long, "left_anti") if any_long else damaged
    short = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    names = pa.schema(
        [
            ("conv_id", _arrow(kind)),
            *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
            *[(c, pa.string()) for c in ("audit", "repaired_sha256")],
        ]
    )
    out = short.mapInArrow(_repair_runs(names), f"conv_id {kind}, {RESULT}")
    if any_long:
        out = out.unionByName(_repair_long(damaged.join(long_ones, is_long, "left_semi"), segment))
    return out
