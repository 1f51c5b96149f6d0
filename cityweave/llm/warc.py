"""WARC archives: write pages, read them back, merge the index into capture histories.

Records with equal payloads of at least ``LEAST_SHARED`` bytes are stored once: that of the smallest page_id is the
response, the others are revisits that refer to it. Archives are gzipped WARC files of bounded size in the shared
folder; Spark's text sink writes them with the two line ends that close a record as its separator. The reader goes by
Content-Length, so nothing inside a payload can be taken for a record, and computes the digest of what it
has read.

Each archive gives a capture run sorted by (URL key, time, page). The runs are written, dealt out by ranges of that order
and merged in each range by a loser tree over the runs, so all ranges together hold the captures in
global order: the history of one URL lies in neighbouring ranges however many captures it has.

Defined results: NULL html is an empty payload; NULL urls have no target and an empty URL key; rows that repeat the
smallest page_id of equal payloads are all responses; of equal payloads without any page_id all are responses; line
ends in a URL are percent-encoded; an empty table gives no archive records; extra columns are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.llm.rows import bound_batches, lower_ascii
from cityweave.llm.url_filter import host_of, path_of
from cityweave.sources.scratch import durable, fresh_path

LEAST_SHARED = 100
ARCHIVE_BYTES = 16 << 20
RANGE_ROWS = 100_000
FIRST_CAPTURE = "2024-01-01T00:00:00Z"
HTTP_HEADER = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
CAPTURE = (
    ("run", "string"),
    ("captured", "string"),
    ("page_id", "bigint"),
    ("url", "string"),
    ("record_type", "string"),
    ("refers_to", "bigint"),
    ("payload_bytes", "bigint"),
    ("payload_digest", "string"),
    ("at", "bigint"),
)


def classify(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (NULL for responses)."""
    payload = F.coalesce("html", F.lit(""))
    found = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2(F.col("payload"), 256)}
    )
    first = (
        pages.select("page_id", payload.alias("payload"))
        .where(F.octet_length("payload") >= LEAST_SHARED)
        .select("page_id", F.sha2(F.col("payload"), 256).alias("shared_digest"))
        .groupBy("shared_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("shared_digest", "first")
    )
    # Only payloads seen twice or more are listed; their size is measured before the join is planned.
    met = found.join(durable(first, "shared-payloads"), F.col("payload_digest") == F.col("shared_digest"), "left")
    others = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.withColumn("refers_to", F.when(others, F.col("first"))).drop("shared_digest", "first")


def capture_time(page_id: Column) -> Column:
    """The tables have no time: one second per page after ``FIRST_CAPTURE``, within a year."""
    start = F.unix_timestamp(F.lit(FIRST_CAPTURE), "yyyy-MM-dd'T'HH:mm:ssX")
    seconds = start + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(31_536_000))
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def record(pages: DataFrame) -> Column:
    """A whole WARC record but for its closing line ends."""
    revisit = F.col("refers_to").isNotNull()
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    length = F.lit(len(HTTP_HEADER)) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))  # NULL if the value is, and left out then

    def urn(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))

    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        line("WARC-Target-URI", target),
        line("WARC-Date", capture_time(F.col("page_id"))),
        line("WARC-Refers-To", urn(F.col("refers_to"))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        line("X-Payload-Length", F.col("payload_bytes")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length),
    )
    body = F.when(revisit, "").otherwise(F.col("payload"))
    return F.concat(header, F.lit(END + HTTP_HEADER), body)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` as WARC files of about ``archive_bytes`` before compression (one record at least)."""
    def size(column: str) -> Column:
        return F.coalesce(F.octet_length(column).cast("long"), F.lit(0))

    total = pages.agg(F.sum(size("html") + size("url") + 600)).first()[0] or 0
    found = classify(pages)
    # Rows go round the archives, so equal ones spread, too; Spark orders them first, so a repeated task deals them alike.
    dealt = found.select(record(found).alias("value")).repartition(int(total // archive_bytes) + 1)
    dealt.write.option("lineSep", END).option("compression", "gzip").text(path)


_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def records_of(archive: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(offset, headers, block) of each record of an unpacked archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        first, *lines = archive[at:end].split(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(b": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers[b"Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end at {stop}")
        yield at, headers, archive[start:stop]
        at = stop + 4


def _page(headers: dict[bytes, bytes], name: bytes) -> int | None:
    found = _PAGE.fullmatch(headers.get(name, b""))
    return int(found[1]) if found else None


def _captures(archive: bytes) -> list[tuple]:
    rows = []
    for at, headers, block in records_of(archive):
        revisit = headers[b"WARC-Type"] == b"revisit"
        payload = block.split(b"\r\n\r\n", 1)[1]
        if revisit:
            digest, size = headers[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"), int(headers[b"X-Payload-Length"])
        else:
            digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
        url = headers.get(b"WARC-Target-URI")
        rows.append(
            (
                headers[b"WARC-Date"].decode(),
                _page(headers, b"WARC-Record-ID"),
                None if url is None else url.decode(),
                headers[b"WARC-Type"].decode(),
                _page(headers, b"WARC-Refers-To"),
                size,
                digest,
                at,
            )
        )
    return rows


def url_key(url: Column) -> Column:
    """Sort-friendly key: the host's labels from the last to the first, then the path."""
    labels = F.array_join(F.reverse(F.split(host_of(url), r"\.")), ",")
    return F.coalesce(F.concat(labels, F.lit(")"), lower_ascii(path_of(url))), F.lit(""))


def _batch(rows: list[tuple], fields: Sequence[tuple[str, str]]) -> pa.RecordBatch:
    types = {"string": pa.string(), "bigint": pa.int64()}
    columns = zip(*rows) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), types[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The index of all archives under ``path``: one row per record, with its archive (``run``) and offset (``at``)."""
    bound_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, content in zip(batch.column(0), batch.column(1)):
                name = run.as_py()
                yield _batch([(name, *row) for row in _captures(gzip.decompress(content.as_py()))], CAPTURE)

    kind = ", ".join(f"{name} {kind}" for name, kind in CAPTURE)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    run = F.element_at(F.split("path", "/"), -1).alias("run")
    return files.select(run, "content").mapInArrow(read, kind).withColumn("url_key", url_key(F.col("url")))


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next item costs one path to the root."""

    def __init__(self, runs: Sequence[Iterator[tuple]]):
        self.runs, self.k = [iter(r) for r in runs], len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for run in range(self.k):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        """An entrant (-1) beats all while the tree is being filled; an empty run loses to all others."""
        if a < 0 or b < 0:
            return a < 0
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and self.heads[a] is not None
        return (self.heads[a], a) < (self.heads[b], b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self._before(self.losers[node], run):
                run, self.losers[node] = self.losers[node], run
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            run = self.losers[0]
            item = self.heads[run]
            if item is None:
                return
            yield item
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def merge_runs(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in global order of (url_key, captured, page_id): by partition, and within it by row."""
    spark = captures.sparkSession
    runs = durable(captures.sortWithinPartitions("run", "url_key", "captured", "page_id", "at"), "capture-runs")
    fields = [*CAPTURE, ("url_key", "string")]
    place = {name: i for i, (name, _) in enumerate(fields)}

    def sortable(row: tuple) -> tuple:
        page = row[place["page_id"]]
        return row[place["url_key"]], row[place["captured"]], page is not None, page or 0, row[place["run"]], row[place["at"]]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                by_run.setdefault(row[place["run"]], []).append((sortable(row), row))
        merged = [row for _, row in LoserTree([by_run[r] for r in sorted(by_run)])]
        for i in range(0, len(merged), 10_000):
            yield _batch(merged[i : i + 10_000], fields)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), runs.count() // range_rows + 1)
    order = ["url_key", "captured", "page_id", "run", "at"]
    ranged = runs.repartitionByRange(parts, *order).sortWithinPartitions("run", *order)
    return ranged.mapInArrow(merge, runs.schema)


def archive(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write, read back and merge: one row per page, from what the archives hold."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, archive_bytes)
    merged = merge_runs(read_captures(spark, path))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )
