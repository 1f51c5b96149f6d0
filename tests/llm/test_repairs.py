"""Conversation repair, spelling variants and exact dedup against plain versions, and rows of every odd kind."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from functools import cache
from zlib import crc32

import numpy as np
import pytest

from cityweave.llm import conversation, exact_dedup, spelling
from cityweave.llm.queries import LLM_QUERIES
from cityweave.llm.rows import table

# --- conversations

CONVERSATION = "conv_id long, turn long, role string, text string, fault int, gone string, pos long"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_damage(rows):
    """Rows (conv_id, turn, role, text) by conversation, damaged and in order."""
    def known(x):
        return " " if x is None else str(x)

    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        kept = out[conv_id]
        fault = crc32(f"{known(conv_id)}:{known(turn)}".encode()) % 20
        role, text = known(role), known(text)
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def plain_repair(rows):
    """Cost, audit and lines by trying every edit, the least (cost, audit) first."""
    seen, facts = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        facts.append((role, text, kind))

    @cache
    def least(i, said, inserted):
        options = []
        if i == len(facts) and re.fullmatch("(s?(ua)+)?", said):
            options.append((0, "", ()))

        def go(letter, cost, rest, line=None):
            options.append((cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2]))

        def shorter(said):  # how many pairs there were does not matter
            return re.sub("(ua)+", "ua", said)

        for role in ("user", "assistant"):
            after = shorter(said + role[0])
            if inserted < 3 and re.fullmatch("s?(ua)*u?", after):
                go("I", 2, least(i, after, inserted + 1), f"{role}:")
        if i < len(facts):
            role, text, kind = facts[i]
            go("D", 3, least(i + 1, said, 0))
            if kind not in ("blank", "duplicate"):
                extra = kind == "truncated"
                for letter, new, cost in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    after = shorter(said + new[:1])
                    if new and re.fullmatch("s?(ua)*u?", after):
                        go(letter, cost + extra, least(i + 1, after, 0), f"{new}:{text}")
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = least(0, "", 0)
    kinds = Counter(kind for _, _, kind in facts)
    initials = [role[:1] for role, _, _ in facts]
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{k: kinds[k] for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def check_conversations(df, **settings):
    rows = [tuple(r)[:4] for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = {conv_id: plain_repair(kept) for conv_id, kept in plain_damage(rows).items()}
    found = conversation.repair(df, **settings).collect()
    assert len(found) == len(want)
    for row in found:
        assert row.asDict() == {"conv_id": row.conv_id, **want[row.conv_id]}
    return want


def odd_conversations():
    draw = random.Random(4)
    roles = ["system", "user", "assistant", "tool", "unknown", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", " \t\n", "", None, "é.", "dot. \n", "long " * 3000]
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}." if t % 3 else "again.") for t in range(40)]
    rows += [
        (draw.choice([2, 3, 4, 5, 6, 7, None]), draw.choice([None, *range(-2, 12)]), draw.choice(roles), draw.choice(texts))
        for _ in range(150)
    ]
    rows += [(8, 3, "user", "The same."), (8, 3, "user", "The same.")] * 3
    lost = next(i for i in range(100, 400) if crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(lost, 0, "user", "Lost.")]
    rows += [(c, t, r, x) for c in range(20, 60) for t, (r, x) in enumerate(draw.choices([(r, x) for r in roles[:3] for x in texts[:5]], k=draw.randrange(1, 9)))]
    return [(*r, 1, "x", 2) for r in rows], lost


@pytest.mark.parametrize("settings", [{}, {"long_rows": 5, "segment": 3}, {"long_rows": 0, "segment": 1}, {"long_bytes": 4000}])
def test_repairs_against_all_edits(spark, settings):
    rows, lost = odd_conversations()
    want = check_conversations(spark.createDataFrame(rows, CONVERSATION).repartition(3), **settings)
    assert want[lost] == {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "", "repaired_sha256": EMPTY}


def test_repair_of_table(spark, small):
    want = check_conversations(table(spark, small, "conversations"))
    assert LLM_QUERIES["op11_conversation"](spark, small).count() == len(want)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], CONVERSATION)
    assert conversation.repair(empty).count() == 0
    assert conversation.repair(empty, long_rows=0).count() == 0


def test_weights_order_like_costs_then_audits():
    """Every audit of up to four letters, padded, sorts as it does in ASCII."""
    audits = ["".join(p) for n in range(5) for p in itertools.product("DIKR", repeat=n)]
    as_number = {a: conversation._digits(a) << conversation.BITS * (4 - len(a)) for a in audits}
    assert sorted(audits) == sorted(audits, key=as_number.get) and len(set(as_number.values())) == len(audits)


# --- spelling


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    """Near words through what is left of a word without one letter; every candidate is compared."""
    bucket = defaultdict(set)
    for w in words:
        for key in {w, *((i, w[:i] + w[i + 1 :]) for i in range(len(w))), *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            bucket[key].add(w)
    near = defaultdict(set)
    for group in bucket.values():
        for a, b in itertools.combinations(group, 2):
            if is_near(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 5 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out[w] = (f, root, n, len(near[w]), words[f] if f else None)
    return out


def check_variants(df, **settings):
    want = plain_variants(plain_words([tuple(r) for r in df.select("doc_id", "text").collect()]))
    found = spelling.variants(df, **settings).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == want
    assert len(found) == len(want)
    return want


@pytest.mark.parametrize("part", [spelling.PART, 7])
def test_variants_of_table(spark, small, part):
    want = check_variants(table(spark, small, "documents"), part=part)
    assert any(v[0] for v in want.values())


def test_variants_odd_rows(spark, odd_docs, no_docs):
    check_variants(odd_docs)
    assert spelling.variants(no_docs).count() == 0
    long_word = "z" * 5000
    texts = {"reading": 130, "readng": 25, "readnga": 5, "rxading": 26, "ryading": 26, "gnidaer": 9, "÷×àÿàÿ": 6, "÷×àÿàà": 30}
    texts |= {long_word: 5, long_word + "y": 30, "q" + long_word + "y": 200}
    docs = [(None if w == "gnidaer" else 0, " ".join([w.upper() if w.isascii() else w] * n), 1) for w, n in texts.items()]
    want = check_variants(spark.createDataFrame(docs, "doc_id long, text string, n int"), part=2)
    assert want["readnga"][1] == "reading" and want[long_word][1] == "q" + long_word + "y"


def test_near_pairs_brute_force():
    draw = random.Random(2)
    words = list({"".join(draw.choice("abé") for _ in range(draw.randrange(6, 9))) for _ in range(400)})
    for a, b in itertools.product([[w for w in words if len(w) == 6], [w for w in words if len(w) == 7]], repeat=2):
        found = set(zip(*map(np.ndarray.tolist, spelling.near_pairs(a, b))))
        assert found == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if is_near(x, y)}


# --- exact dedup


def check_copies(df, **settings):
    """Groups, sizes and ids exactly; of rows with the largest id one stays."""
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    found = exact_dedup.judge(df, **settings).collect()
    assert Counter((r.row.doc_id, r.row.text or "", r.keep_id, r.group_size) for r in found) == Counter(
        (i, t, largest[t], len(groups[t])) for i, t in rows
    )
    kept = [(r.row.text or "", r.row.doc_id) for r in found if r.kept]
    assert sorted(kept, key=str) == sorted(largest.items(), key=str)
    once = exact_dedup.one_of_each(df)
    assert once.columns == df.columns and once.count() == len(groups)


@pytest.mark.parametrize("most", [exact_dedup.MOST_BROADCAST, 3])
def test_copies(spark, small, odd_docs, no_docs, most):
    check_copies(table(spark, small, "documents"), most_broadcast=most)
    check_copies(odd_docs.unionByName(odd_docs), most_broadcast=most)
    assert exact_dedup.judge(no_docs, most_broadcast=most).count() == 0


def test_texts_that_differ_late(spark):
    start = "a" * 3000
    rows = [(1, start + "x"), (2, start + "y"), (3, start + "x"), (None, start + "y"), (None, "n"), (None, "n"), (4, ""), (5, None)]
    check_copies(spark.createDataFrame(rows, "doc_id long, text string"))
