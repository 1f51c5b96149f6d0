"""Operators on documents: brute force, round trips, and rows of every odd kind."""

import base64
import hashlib
import itertools
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from notations import HARD, PLANTED

import corpus_pipeline
from cityweave.llm import compression, line_dedup, mixing, pieces, pii, rule_ensemble, simhash, trees
from cityweave.llm.rows import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# --- SimHash


def plain_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def check_components(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots))
    assert Counter(map(tuple, simhash.with_component_ids(docs).collect())) == want
    return len(set(roots))


def test_simhash_brute_force(spark, small):
    check_components(table(spark, small, "documents"))


def test_simhash_odd_rows(odd_docs, no_docs):
    groups = check_components(odd_docs)
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == groups
    assert simhash.with_component_ids(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 500])
def test_crowded_blocks_lose_no_link(spark, limit):
    draw = random.Random(limit)
    centre = draw.getrandbits(64)
    prints = {centre ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(5))) for _ in range(150)}
    prints = [p % (1 << 64) for p in prints] + [draw.getrandbits(64) for _ in range(40)]
    signed = [simhash._signed(p) for p in prints]
    links = simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"), crowded_above=limit)
    found = {r.node: r.root for r in simhash.connect(links).collect()}
    roots = plain_components(prints)
    for (a, p), (b, q) in itertools.combinations(zip(roots, signed), 2):
        assert (a == b) == (found.get(p, p) == found.get(q, q))


# --- mixing


def test_mix(odd_docs, no_docs):
    rows = mixing.plan_mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    total = sum(r.size for r in rows)
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    for mine in by_source.values():
        assert mine[0].source_size == sum(r.size for r in mine) and mine[0].target <= 2 * mine[0].source_size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
    assert abs(sum(m[0].target for m in by_source.values()) - 1.5 * total) < 1e-6
    assert all(r.taken <= 2 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan_mix(odd_docs.repartition(5)).collect()))
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.plan_mix(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


# --- line dedup


def test_line_dedup_odd_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.select("doc_id", "text", "source").collect()]
    texts = {(r["source"], r["text"]) for r in rows if r["text"] is not None}
    pages = Counter(source for source, _ in texts)
    seen = Counter((s, line) for s, t in texts for line in {x.strip(" \t\r\x0b\x0c") for x in t.split("\n")})
    bad = {k for k, n in seen.items() if k[1] and n >= line_dedup.LEAST_PAGES and n > line_dedup.RATIO * pages[k[0]]}
    assert bad == {("a", "shared footer line")}
    want = Counter(
        None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" \t\r\x0b\x0c")) not in bad)
        for r in rows
    )
    out = line_dedup.without_boilerplate(odd_docs)
    assert out.columns == odd_docs.columns
    got = out.collect()
    assert Counter(r.text for r in got) == want
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    assert line_dedup.without_boilerplate(no_docs).count() == 0


def test_line_on_a_few_per_cent_of_every_source_goes(spark):
    footers = {0: "Lire la suite de cet article", 1: "Mehr zu diesem Thema", 2: "Read on"}  # 8 %, 4 % and 2 % of each source

    def text(i):
        k = next((k for k in footers if i % 100 < (8, 12, 14)[k]), None)
        return f"page {i} of its own\n" + footers.get(k, f"end {i}")

    rows = [(s * 1000 + i, text(i), f"source{s}") for s in range(4) for i in range(300)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    left = [r.kept for r in out.collect()]
    assert not any(f in t for f in footers.values() for t in left)
    assert all(t.startswith("page ") for t in left) and sum("\nend " in t for t in left) == 4 * 258


def test_small_sites_have_boilerplate(spark):
    rows = [(s * 10 + i, f"page {i}\nfooter\n{'pair' if i < 2 else i}", f"s{s}") for s in range(4) for i in range(3)]
    out = line_dedup.without_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.text for r in out.collect()} == {"page 0\npair", "page 1\npair", "page 2\n2"}


def test_copies_erase_nothing(spark, small):
    """Three copies of a page in a site of ten keep their lines; a table three times over loses what it loses once."""
    rows = [(i, f"page {max(i, 7)} of many\nits own line {max(i, 7)}\nfooter", "s") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = line_dedup.without_boilerplate(docs).collect()
    assert Counter(r.text for r in out) == Counter(f"page {max(i, 7)} of many\nits own line {max(i, 7)}" for i in range(10))
    docs = table(spark, small, "documents")
    once = Counter(r.text for r in line_dedup.without_boilerplate(docs).collect())
    thrice = Counter(r.text for r in line_dedup.without_boilerplate(docs.unionAll(docs).unionAll(docs)).collect())
    assert thrice == Counter({t: 3 * n for t, n in once.items()})


def test_copies_are_no_boilerplate_in_the_pipeline(spark):
    rows = [(i, "all of this\nis copied" if i % 20 == 0 else f"page {i}\nfooter", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.text for r in corpus_pipeline.lines(spark, docs, "").collect()} == {"all of this\nis copied", *[f"page {i}" for i in range(400) if i % 20]}


# --- compression


def plain_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, x in enumerate(windows) if x in often for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def test_compression(spark, small, odd_docs, no_docs):
    for docs in (table(spark, small, "documents"), odd_docs):
        texts = Counter((r.doc_id, *plain_counts(r.text)) for r in docs.select("doc_id", "text").collect())
        rows = compression.judge(docs).collect()
        assert Counter(tuple(r[:6]) for r in rows) == texts
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
        assert not any(r.kept and r.base_failed for r in rows)
    assert compression.judge(no_docs).count() == 0
    compress = zstandard.ZstdCompressor(level=3).compress
    draw = random.Random(1)
    noise = " ".join("".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(2000))
    prose = " ".join(draw.choice("abcdefghij") * 2 + str(draw.randrange(900)) for _ in range(900))
    assert compression.judge_text(prose, compress).kept
    assert not compression.judge_text(noise, compress).kept  # incompressible
    assert not compression.judge_text(prose + "x" * 60_000, compress).kept  # repetitive chunks
    assert [len(c) for c in compression.chunks_of(b"x" * 9000, 4096)] == [4096, 4904]


def test_compression_bands_meet_parts_of_a_text():
    compress = zstandard.ZstdCompressor(level=3).compress
    draw = random.Random(2)
    terms = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(draw.choices(terms, k=n))[:n]

    def encoded(n):
        return base64.encodebytes(draw.randbytes(n)).decode()[:n]

    assert all(compression.judge_text(prose(n), compress).kept for n in (500, 1000, 2000, 4000, 8000, 30_000))
    assert not compression.judge_text(prose(10_000) + encoded(12_000), compress).kept
    assert not compression.judge_text(prose(9000) + "buy now and save a lot, " * 340 + prose(9000), compress).kept
    for n in (400, 900, 1900, 4000, 8000, 30_000):  # with words enough for the base rules
        assert not compression.in_bands(encoded(n).encode(), compress)[2]


def test_fitted_compression_bands(spark, odd_docs, no_docs):
    """Bands and verdicts against a plain version; bad documents go, good ones that had no part in the fit stay."""
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    compress = zstandard.ZstdCompressor(level=3).compress
    facts = []
    for r in docs.collect():
        raw, counts = (r.text or "").encode(), plain_counts(r.text)
        if counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0]:
            cuts = [raw[i : i + 1024] for i in range(0, len(raw), 1024)]
            if len(cuts) > 1 and len(cuts[-1]) < 512:
                cuts[-2:] = [cuts[-2] + cuts[-1]]
            facts.append((r.doc_id, len(raw), len(compress(raw)) / len(raw), [(len(c), len(compress(c)) / len(c)) for c in cuts]))
    fitted = compression.fit_bands(docs, labels)
    by_length = {}
    for doc_id, size, ratio, _ in facts:
        if quality.get(doc_id) == 1:
            by_length.setdefault(math.floor(2 * math.log2(size) + 1e-9), []).append(ratio)
    assert set(fitted) == {k for k, v in by_length.items() if len(v) >= 30} and len(fitted) > 8
    for k, (low, high) in fitted.items():
        ratios = sorted(by_length[k])
        assert low + 0.01 in ratios[: len(ratios) // 50 + 1] and high - 0.01 in ratios[-len(ratios) // 50 - 1 :]

    def fine(size, ratio):
        low, high = fitted.get(math.floor(2 * math.log2(size) + 1e-9)) or next(b[1:] for b in compression.BANDS if size <= b[0])
        return low <= ratio <= high

    want = {i for i, size, ratio, cuts in facts if fine(size, ratio) and 5 * sum(not fine(*c) for c in cuts) <= len(cuts)}
    judged = compression.judge(docs, fitted).collect()
    assert {r.doc_id for r in judged if r.kept} == want
    bad = [r for r in judged if not r.base_failed and quality.get(r.doc_id) == 0]
    assert sum(not r.kept for r in bad) > 0.6 * len(bad) > 150
    is_test = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    others = compression.fit_bands(docs, labels.where(~is_test))
    held = {r.doc_id for r in labels.where(is_test).where("quality = 1").collect()}
    good = [r for r in compression.judge(docs, others).collect() if not r.base_failed and r.doc_id in held]
    assert sum(not r.kept for r in good) < 0.02 * len(good) and len(good) > 500
    assert compression.fit_bands(no_docs, labels) == {} == compression.fit_bands(docs, labels.limit(0))
    assert compression.judge(odd_docs, fitted).count() == odd_docs.count()


def test_compression_bands_use_every_label(spark):
    """The longer texts are those whose hashes come after 20,000 others."""
    ids = spark.range(20_040).select(F.col("id").alias("doc_id"))
    last = {r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").collect()[20_000:]}
    words = "concat_ws(' ', transform(sequence(1, if(doc_id in ({}), 600, 60)), x -> hex(xxhash64(doc_id, x))))"
    docs = ids.selectExpr("doc_id", words.format(",".join(map(str, last))) + " as text")
    fitted = compression.fit_bands(docs, ids.withColumn("quality", F.lit(1)))
    assert max(fitted) - min(fitted) > 4


# --- SentencePiece


def test_segmentation_shares():
    v = pieces.read_vocabulary()
    weight = {p: w for p, _, w in v.pieces}

    def cuts(x):
        if not x:
            yield ()
        for n in range(1, len(x) + 1):
            if x[:n] in weight:
                yield from ((x[:n], *rest) for rest in cuts(x[n:]))

    share = {c: math.prod(weight[p] for p in c) for c in cuts(" those")}
    whole, n = sum(share.values()), 20_000
    sampler = pieces.Sampler(v)
    got = Counter(tuple(v.text[i].decode() for i in sampler.encode("those", pieces.key_draw(k, 1))) for k in range(n))
    assert set(got) <= set(share)
    assert all(abs(got[c] / n - s / whole) < 0.01 for c, s in share.items())


def test_segmentation_is_the_same_whatever_is_remembered(spark, small):
    v = pieces.read_vocabulary()
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    fresh = [pieces.Sampler(v).encode(t, pieces.key_draw(i, 1)) for i, t in rows[:20]]
    warm = pieces.Sampler(v)
    for _ in range(2):
        every = [warm.encode(t, pieces.key_draw(i, 1)) for i, t in rows]
        assert every[:20] == fresh


def test_segmentation_shares_across_chunks(spark):
    """Texts of several chunks, with spelled characters: shares of the product of weights over all segmentations."""
    v = pieces.read_vocabulary()
    weight = {p: w for p, _, w in v.pieces}
    text = " ab\u2603, é"

    def spelled(c):
        return math.prod(v.weights[v.byte_ids[b]] for b in c.encode())

    def cuts(x):
        if not x:
            yield (), 1.0
        for n in range(1, len(x) + 1):
            one = weight.get(x[:n]) or (spelled(x[:1]) if n == 1 and x[:1] not in weight else None)
            if one:
                yield from (((x[:n], *rest), one * w) for rest, w in cuts(x[n:]))

    share = dict(cuts(text))
    whole, n = sum(share.values()), 20_000
    sampler = pieces.Sampler(v)
    got = Counter(tuple(ids.tolist()) for ids in sampler.encode_rows([text[1:]] * n, [pieces.key_draw(k, 1) for k in range(n)]))
    id_of = {p: i for p, i, _ in v.pieces}
    for cut, w in share.items():
        ids = [i for p in cut for i in ([id_of[p]] if p in id_of else [v.byte_ids[b] for b in p.encode()])]
        assert abs(got[tuple(ids)] / n - w / whole) < 0.012
    assert len(share) > 4 and set(map(len, got)) <= {sum(len(p.encode()) if p not in id_of else 1 for p in c) for c in share}


def test_segmentation_does_not_depend_on_slices(spark, small, monkeypatch):
    """Small slices, chunks taken one by one and in small blocks give the same pieces."""
    v = pieces.read_vocabulary()
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()][:60]
    rows += [(-1, "x" * 300 + "\u2603" + "yz" * 9000), (-2, "-" * 500), (-3, "a b" * 50), (-4, None), (-5, "")]
    texts, begins = [t for _, t in rows], [pieces.key_draw(i, 1) for i, _ in rows]
    want = [ids.tolist() for ids in pieces.Sampler(v).encode_rows(texts, begins)]
    assert all(pieces.decode(ids, v) == (t or "") for ids, t in zip(want, texts))
    for settings in ({"SLICE": 100}, {"LONG": 0, "BLOCK": 7}, {"LONG": 4, "BLOCK": 1 << 12}, {"SLICE": 1}):
        with monkeypatch.context() as patch:
            for name, value in settings.items():
                patch.setattr(pieces, name, value)
            assert [ids.tolist() for ids in pieces.Sampler(v).encode_rows(texts, begins)] == want


def test_segmentation_keeps_pieces(odd_docs):
    v = pieces.read_vocabulary()
    for row in pieces.segment(odd_docs).collect():
        assert row.decoded == (row.text or "") == pieces.decode(row.pieces, v)
    long_chunk = odd_docs.limit(1).selectExpr("doc_id", "repeat('abcdefghij', 20000) as text")
    (row,) = pieces.digests(long_chunk).collect()
    assert row.lossless and row.n_chars == 200_000 and len(row.pieces) == row.n_pieces


def test_segmentation_round_trip(odd_docs, no_docs):
    v = pieces.read_vocabulary()
    sampler = pieces.Sampler(v)
    for text in ("a\n\n b  c ▁x\t", "日本語 𝔘 \u0000 é", "x" * 5000, " " * 300, "a_b_{c} x².", "\r\n", "un-seen☃☃"):
        for k in range(5):
            assert pieces.decode(sampler.encode(text, pieces.key_draw(k, 1)), v) == text
    rows = pieces.digests(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.lossless for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, pieces.digests(odd_docs.repartition(3)).collect()))
    assert pieces.digests(no_docs).count() == 0


# --- quality classifier


def plain_statistics(text):
    text = text or ""
    rest, n = re.sub("[a-zß-öø-ÿ ]+", "", text), max(len(text), 1)
    parts = re.split(r"[\x20\x09-\x0D]+", text)

    def share(test):
        return sum(map(test, rest)) / n

    return [
        math.log1p(len(parts)), n / len(parts), share("#*$%&|<>".__contains__), share("!?".__contains__), share("|".__contains__),
        share(".,;:".__contains__), share("0123456789".__contains__), share("\n".__contains__),
        share(lambda c: unicodedata.category(c) == "Lu"), len(set(parts)) / len(parts),
    ]


def test_quality_scores_equal_the_rules(spark, small, odd_docs):
    """Every score against the rules and weights applied to plain statistics."""
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    model = rule_ensemble.fit(docs, labels)
    assert model.rules
    for df in (docs, odd_docs):
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            stats = plain_statistics(r.text)
            total = model.intercept
            for rule, weight in zip(model.rules, model.weights):
                total += weight * all(stats[f] > t if above else stats[f] <= t for f, above, t in rule)
            score = 1 / (1 + math.exp(-total))
            held_out = r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            want[r.doc_id, held_out, round(score, 9), int(score >= 0.3)] += 1
        found = rule_ensemble.score(df, model).collect()
        assert Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in found) == want


def test_quality_held_out(spark, odd_docs, no_docs):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = rule_ensemble.fit(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, known[r.doc_id]) for r in rule_ensemble.score(docs, model).collect() if r.held_out and known.get(r.doc_id) is not None]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.95 * len(held)
    rows = rule_ensemble.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = rule_ensemble.keep_good(odd_docs, model)
    assert good.columns == odd_docs.columns and good.count() == sum(r.predicted for r in rows)
    assert rule_ensemble.score(no_docs, model).count() == 0
    assert rule_ensemble.fit(docs, labels.limit(0)).rules == []


# --- personal data


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern, fine in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    ):
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if fine(m[0])]
    return ",".join(out)


ODD_TEXTS = [
    "a@b.c@d.e x@y @z.q a..b@c-d.e.f. me@host me@host.x1", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3", "4111 1111 1111 1111-1 4111-1111-1111-1111",
    "+1 (803) 555-5351 +49.30.1234567 +1+2222222222 +12345678", "a@" * 50 + "b.c", "0" * 4000 + ".1.1.1", "é@é.é ü@a.b",
]


def test_personal_data_base(spark, small, odd_docs, no_docs):
    nothing = pii.Model([], {})
    odd = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    for docs in (table(spark, small, "documents"), odd_docs, odd):
        want = Counter(
            (r.doc_id, hashlib.sha256(plain_spans(r.text).encode()).hexdigest(), plain_spans(r.text))
            for r in docs.select("doc_id", "text").collect()
        )
        assert Counter((r.doc_id, r.base_sha256, r.spans) for r in pii.find(docs, nothing).collect()) == want
    assert pii.find(no_docs, nothing).count() == 0 and pii.fit(no_docs) == nothing


def test_every_window_of_digit_groups_is_proposed():
    for text, kind, part in (
        ("card 4111 1111 1111 1111 12/27", "card", "4111 1111 1111 1111"), ("4111 1111 1111 1111 5500 0000 0000 0004", "card", "5500 0000 0000 0004"),
        ("in 2024 555-123-4567", "phone", "555-123-4567"), ("room 12 (555) 123-4567 (new)", "phone", "(555) 123-4567"),
    ):
        at = text.index(part)
        assert pii.Span(kind, at, at + len(part)) in pii.proposals(text)
    assert len(pii.proposals("1234 " * 10_000)) < 100_000


def test_numbers_beside_numbers_are_taken(spark):
    model = pii.fit(table(spark, "/root/testdata/sf0.1", "documents"))

    def taken(text):
        return {(s.kind, text[s.start : s.end]) for s in pii.all_spans(text, pii.base_spans(text), model)}

    assert ("card", "4111 1111 1111 1111") in taken("pay by card 4111 1111 1111 1111 12/27 please")
    assert taken("cards 4111 1111 1111 1111 5500 0000 0000 0004 end") >= {("card", "4111 1111 1111 1111"), ("card", "5500 0000 0000 0004")}
    assert ("phone", "(555) 123-4567") in taken("call room 12 (555) 123-4567 now")
    assert ("phone", "555-123-4567") in taken("call in 2023 555-123-4567 now")


def test_each_kind_has_its_own_sample(spark):
    rows = [(i, f"write to user{i}@example.com" + (f" or 10.0.0.{i // 400}" if i % 400 == 0 else "")) for i in range(12_000)]
    found = pii.sampled_spans(spark.createDataFrame(rows, "doc_id long, text string"), spans_per_kind=100)
    assert Counter(r[0] for r in found) == {"email": 100, "ip": 30} and len({r[:2] for r in found}) == 130


def test_address_parts_of_any_length():
    assert pii.base_spans("0" * 5000 + "7.1.1." + "0" * 5000) == [pii.Span("ip", 0, 10_006)]
    assert pii.base_spans("0" * 5000 + "256.1.1.1") == []


def test_personal_data_model(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = pii.fit(docs)
    assert set(model.thresholds) == set(pii.KINDS)
    held = [x for x in pii.examples(pii.sampled_spans(docs)) if x[0]]
    taken = [label for _, kind, label, x in held if pii.score(model, x) >= model.thresholds[kind]]
    assert sum(taken) >= 0.97 * len(taken) and sum(taken) >= 0.8 * sum(label for _, _, label, _ in held)
    spans = pii.all_spans("write to jo.34 [at] mail7 [dot] example [dot] com or call (803) 555-5351, on 2021-05-04", [], model)
    assert {s.kind for s in spans} >= {"email"} and all(s.end <= 72 for s in spans)
    marked = spark.createDataFrame([("ab 1 cd", "card:3:4"), (None, "ip:0:1"), ("x", None)], "text string, spans string")
    assert [r[0] for r in marked.select(pii.redact(marked.text, marked.spans)).collect()] == ["ab [card] cd", None, "x"]


def test_notations_are_caught(spark):
    """At least 0.9 of each kind of the planted notations, as whole spans, and next to nothing of what only looks like them."""
    model = pii.fit(table(spark, "/root/testdata/sf0.1", "documents"))
    for kind, planted in PLANTED.items():
        caught = 0
        for text, part in planted:
            wanted = pii.Span(kind, text.index(part), text.index(part) + len(part))
            assert wanted in pii.proposals(text), text
            caught += wanted in pii.all_spans(text, pii.base_spans(text), model)
        assert caught >= 0.9 * len(planted), kind
    added = sum(len(pii.all_spans(t, base, model)) - len(base) for t in HARD if (base := pii.base_spans(t)) is not None)
    assert added <= 0.05 * sum(map(len, PLANTED.values()))


def test_proposals_of_hard_texts_are_linear():
    """Twice the text gives twice the proposals, but for windows of up to 19 groups at the ends; scores taken together are those taken alone."""
    for piece in ("1 ", "at dot ", "a@", "1.", "a at b dot ", "(1) ", "\u0661", "x [at] y [dot] ", "@.", "1 - "):
        counts = [sum(1 for _ in pii.proposed(pii.plain(piece * n))) for n in (2000, 4000)]
        assert counts[1] <= 2 * counts[0] + 19 * 19 and counts[1] <= 200_000, piece
    assert pii.plain("\uff14\u0661\u2011\u00a0x") == "41- x"
    leaf = [((0, False, 1.0),), ((0, True, 1.0), (1, False, 0.5)), ((0, True, 1.0), (1, True, 0.5))]
    model = pii.Model([(0.5, [pii.Leaf(tuple(trees.Condition(*c) for c in path), float(i)) for i, path in enumerate(leaf)])], {})
    rows = [[x, y] for x in (0.0, 1.0, 2.0) for y in (0.0, 0.5, 1.0)]
    assert pii.scores(model, rows).tolist() == [pii.score(model, r) for r in rows]
