"""Operators on pages and embeddings: odd rows and brute force."""

import gzip
import math
import random
import statistics
from fractions import Fraction

from cityweave.llm import topk, url_filter, warc


def test_url_filter_odd_rows(spark):
    urls = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "no scheme porn": ("", "", None, "block"),
        "HTTP://A.Example.NET/en/x?casino": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://shop.net/a": ("shop.net", "/a", "net/", "block"),
        "http://shop.net": ("shop.net", "", None, "allow"),
        "http://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "http://casinowin.com/": ("casinowin.com", "/", None, "allow"),  # no boundary
        "http://casino.com/casino": ("casino.com", "/casino", None, "allow"),  # one distinct soft term
        "http://casino-win.com/": ("casino-win.com", "/", None, "block"),
        "x://h#f://g": ("h", "", None, "allow"),
        "http://long.com/" + "a" * 100_000: ("long.com", "/" + "a" * 100_000, None, "allow"),
    }
    rows = [(i % 3 or None, u) for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as hits")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    assert {(r.host, r.path, r.rule, r.verdict) for r in got} == set(urls.values())
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_weights(spark):
    """Weights add up over distinct terms; a vocabulary may come from a table, with terms of any weight."""
    urls = {
        "http://a.com/free/cheap/deal": (0, 3, 3, "allow"),
        "http://a.com/free/cheap/deal/gratis": (0, 4, 4, "block"),
        "http://a.com/wetten/billig": (0, 2, 3, "allow"),
        "http://a.com/apuestas?ruleta": (0, 2, 4, "block"),
        "http://a.com/loterie-gratuit-promo/FREE": (0, 4, 5, "block"),
        "http://a.com/porno-gratis": (2, 1, 9, "block"),
        "http://a.com/warez": (1, 0, 4, "block"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = [(r.strict_hits, r.soft_hits, r.weight, r.verdict) for r in url_filter.judge(pages).orderBy("page_id").collect()]
    assert got == list(urls.values())
    table = [(f"term{i}", 1 + i % 9) for i in range(5000)] + [("TERM8", 3), ("", 9), (None, 9), ("zero", 0)]
    words = url_filter.read_vocabulary(spark.createDataFrame(table, "term string, weight int"))
    assert len(words) == 5000 and words["term8"] == 9
    pages = spark.createDataFrame([(1, "http://term0.com/term1/term3-term3"), (2, "http://term7.com/xterm8")], "page_id long, url string")
    got = url_filter.judge(pages, vocabulary=words, limit=8).orderBy("page_id").collect()
    assert [(r.strict_hits, r.soft_hits, r.weight, r.verdict) for r in got] == [(0, 3, 7, "allow"), (1, 0, 8, "block")]
    assert url_filter.judge(pages, vocabulary={}).where("verdict = 'block'").count() == 0


def test_warc_odd_rows(spark):
    same, tricky = "x" * 150, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    rows = [
        (5, "http://b.com/1", same), (3, "http://a.b.com/2\r\nX: y", same), (9, None, same), (3, "http://c.com", same),
        (1, "http://d.com", "short"), (2, "http://d.com", "short"), (4, None, None), (6, "", ""), (None, "http://e.com", "é" * 60),
        (7, "http://t.com", tricky * 9), (8, "http://l.com", "long " * 200_000), (11, "http://e.com/ä", "é" * 60),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as payload", "2 as run")
    got = warc.archive(pages, archive_bytes=3000).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got)
    assert kinds == sorted([
        (5, "revisit", 3, 150), (3, "response", 0, 150), (9, "revisit", 3, 150), (3, "response", 0, 150), (1, "response", 0, 5),
        (2, "response", 0, 5), (4, "response", 0, 0), (6, "response", 0, 0), (0, "revisit", 11, 120),
        (7, "response", 0, 9 * len(tricky)), (8, "response", 0, 1_000_000), (11, "response", 0, 120),
    ])
    assert [(r.url_key, r.captured) for r in got] == sorted((r.url_key, r.captured) for r in got)
    assert warc.archive(pages.limit(0)).count() == 0


def test_archives_are_well_formed(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, 20_000)
    files = [f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part-")]
    assert len(files) > 2
    assert sum(1 for f in files for _ in warc.records_of(gzip.decompress(f.read_bytes()))) == pages.count()


def test_archives_keep_their_size(spark, tmp_path):
    """Pages without a URL, or without a text, and many equal rows go into as many archives as their bytes need."""
    rows = {
        "no url": [(i, None, f"page {i} " * 20) for i in range(2000)],
        "no text": [(i, "http://a.com/" + "x" * 100, None) for i in range(2000)],
        "equal": [(7, "http://a.com/7", "the same page " * 8)] * 5000,
    }
    for k, name in enumerate(rows):
        path = tmp_path / str(k)
        warc.write_archives(spark.createDataFrame(rows[name], "page_id long, url string, html string"), str(path), 100_000)
        sizes = [len(gzip.decompress(f.read_bytes())) for f in path.iterdir() if f.name.startswith("part-")]
        assert len(sizes) > 10 and max(sizes) < 150_000, name
        assert max(sizes) < 1.5 * statistics.mean(sizes), name


def test_loser_tree():
    draw = random.Random(3)
    for k in range(9):
        runs = [sorted((draw.randrange(50),) for _ in range(draw.randrange(12))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_topk_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, [round(draw.gauss(0, 1), 1) for _ in range(8)]) for i in range(130)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (201, rows[3][1]), (220, None), (240, [1.0, None]), (260, [math.nan] * 8)]
    rows += [(280, [math.inf] * 8), (300, [3e9] * 8), (320, []), (340, [1.0]), (None, rows[3][1])]
    rows += [(360, [2.0**25, -0.3] * 4), (361, [-(2.0**60), 1e300, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0]), (380, [1e308] * 8), (381, [-2.5 * 2.0**51] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as score")
    whole = [(i, [math.floor(64 * Fraction(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, a in whole:
        if q is not None and q % 20 == 0:
            scores = [(c, min(max(sum(x * y for x, y in zip(a, b)), -(1 << 63)), (1 << 63) - 1)) for c, b in whole if c != q]
            scored = [(-s, c is None, c or 0) for c, s in scores]
            want |= {(q, n, None if none else c, -s) for n, (s, none, c) in enumerate(sorted(scored)[:20], 1)}
    assert {tuple(r) for r in topk.search(vectors).collect()} == want
    assert topk.search(vectors.limit(0)).count() == 0
    only_wide = topk.search(vectors.where("vec_id in (360, 361, 380)")).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in only_wide} == {(360, 1, 380), (360, 2, 361), (380, 1, 360), (380, 2, 361)}
