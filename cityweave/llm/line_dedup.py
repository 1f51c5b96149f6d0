"""Line dedup by site-relative frequency, in DataFrame operations only.

Pages are grouped by host. For each line the pages of a host that contain it are counted and divided by the pages
of that host; a line above ``ratio`` is boilerplate of that host and is dropped from its pages. Pages of a host with
equal texts count as one page, however many copies there are, so copies never make a page's own lines boilerplate.

Lines travel as 16-byte digests and are counted with partial sums in each task, so neither a host with a large part
of all pages nor a line on all of them meets in one task. At most (mean lines per page) / ``ratio`` lines of a host can be
above ``ratio``, so the list kept for a host is bounded whatever its size; it is split into ``PARTS`` by hash, of which a line is
looked up in one. The join back to the pages has one row per host on its small side: the planner broadcasts it by its
measured file size, or AQE splits a hot host. Joining by page instead would shuffle all texts.

The ratio lies well below the share of boilerplate in a site of several languages, where a line of one
language is only on pages of that language.

Defined results: lines are compared without white space at their ends; blank lines are never dropped; a line
counts once per page; a line on fewer than ``least_pages`` pages of a host is never dropped; a NULL host is a host of its
own; NULL text stays NULL and is no page; repeated rows are copies; texts of any length are read whole; a page of nothing but
boilerplate keeps an empty text; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.llm.rows import as_row
from cityweave.sources.scratch import durable

RATIO = 0.01
LEAST_PAGES = 3
PARTS = 64
_EDGES = " \t\r\x0b\x0c"


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(_EDGES))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_bare(line)))


def _part(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(PARTS)).cast("int")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float, least_pages: int) -> DataFrame:
    """One row per host that has boilerplate: host, lines (its digests by part)."""
    page = F.when(F.col(text).isNotNull(), F.xxhash64(text))
    totals = durable(pages.groupBy(F.col(host).alias("host")).agg(F.count_distinct(page).alias("pages")), "host-pages")
    filled = F.filter(_lines(F.col(text)), lambda line: _bare(line) != "")
    on_page = pages.select(
        F.col(host).alias("host"), page.alias("page"), F.explode(F.array_distinct(F.transform(filled, _digest))).alias("line")
    )
    counted = on_page.groupBy("host", "line").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= least_pages)
    met = counted.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    above = met.where(F.col("n") > F.col("pages") * F.lit(ratio)).select("c.host", "line", _part(F.col("line")).alias("part"))
    parts = above.groupBy("host", "part").agg(F.collect_list("line").alias("lines"))
    return parts.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("part", "lines"))).alias("lines"))


def dedup_lines(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """Columns ``row`` (the input row), ``kept`` (its text without boilerplate), ``n_lines`` and ``n_dropped``."""
    listed = durable(boilerplate(pages, host, text, ratio, least_pages), "boilerplate")
    rows = pages.select(as_row(pages).alias("row"), F.col(host).alias("host"), F.col(text).alias("whole"))
    met = rows.alias("r").join(listed.alias("b"), F.col("r.host").eqNullSafe(F.col("b.host")), "left")

    def listed_here(line: Column) -> Column:
        part = F.try_element_at("lines", _part(_digest(line)))
        return F.coalesce(F.array_contains(part, _digest(line)), F.lit(False))

    stays = F.filter(_lines(F.col("whole")), lambda line: (_bare(line) == "") | ~listed_here(line))
    met = met.withColumn("stays", F.when(F.col("lines").isNotNull() & F.col("whole").isNotNull(), stays))
    n_lines = F.coalesce(F.size(_lines(F.col("whole"))), F.lit(0))
    edited = F.col("stays").isNotNull()
    return met.select(
        "row",
        F.when(edited, F.concat_ws("\n", "stays")).otherwise(F.col("whole")).alias("kept"),
        F.when(F.col("whole").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(edited, n_lines - F.size("stays")).otherwise(0).cast("long").alias("n_dropped"),
    )


def without_boilerplate(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; ``n_chars``, if there, follows."""
    found = dedup_lines(docs, **settings)
    follow = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[follow.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
