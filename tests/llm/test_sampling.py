"""Consistent weighted sampling against a plain restatement, and its odd cases."""

import hashlib
import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from recount.llm import weighted_sampling as ws
from tests.llm.conftest import SMALL

MASK = (1 << 64) - 1


def _xxh(value: int) -> int:
    return xxhash.xxh64((value & MASK).to_bytes(8, "little"), 42).intdigest()


def _fingerprint(text, samples=ws.SAMPLES):
    counts = Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    if not counts:
        return []
    out = []
    for i in range(samples):
        best = (math.inf, None)
        for word, n in counts.items():
            term = xxhash.xxh64(word.encode(), 42).intdigest()
            x, y, z = (_xxh(term ^ (ws._key(3 * i + j) & MASK)) for j in range(3))
            u = lambda h, high: ((h >> 32 if high else h & 0xFFFFFFFF) + 0.5) * 2.0**-32
            r, c, b = -math.log(u(x, 1) * u(x, 0)), -math.log(u(y, 1) * u(y, 0)), u(z, 1)
            t = math.floor(math.log(n) / r + b)
            best = min(best, (math.log(c) - r * (t + 1 - b), (word, t)))
        out.append(best[1])
    return out


def _edited(rows):
    """(id, text) -> edited text, by the order of the documents."""
    out = {}
    for (i, t), (_, nxt) in zip(rows, [*rows[1:], rows[0]]):
        m = len(t) // 4
        out[i] = t[: len(t) - m] + nxt[:m]
    return out


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("length(text) < 3000")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in ws.edit_fingerprints(docs).collect()}
    assert len(got) == len(rows) > 100
    edited = _edited(rows)
    own = {i: _fingerprint(t) for i, t in rows[:61]}
    share = lambda a, b: sum(x == y for x, y in zip(a, b)) / ws.SAMPLES if a and b else float(a == b)
    for (i, t), (j, _) in zip(rows[:60], rows[1:61]):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r.near_edited == share(own[i], _fingerprint(edited[i])) and r.near_next == share(own[i], own[j])
        assert len(r.fingerprint) == (4 * ws.SAMPLES if own[i] else 0)
    prints = {}
    for i, t in rows:
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint


def test_collision_rate_is_the_weighted_jaccard(spark):
    a = " ".join(f"w{i}" for i in range(60) for _ in range(1 + i % 5))
    b = " ".join(f"w{i}" for i in range(20, 90) for _ in range(1 + i % 3))
    x, y = Counter(a.split()), Counter(b.split())
    true = sum((x & y).values()) / sum((x | y).values())
    df = spark.createDataFrame([(0, a), (1, b)], "k long, t string")
    n = 128
    found = {r.k: bytes(r.fingerprint) for r in ws.signatures(df, "t", ["k"], samples=n, reach=None).collect()}
    same = sum(found[0][2 * i : 2 * i + 2] == found[1][2 * i : 2 * i + 2] for i in range(n)) / n
    assert abs(same - true) < 4 * math.sqrt(true * (1 - true) / n)


def test_terms_left_out_by_the_bound_change_nothing(spark):
    """A reach so small that many texts stay open: these are judged again with all their terms."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    of = lambda reach: {r.doc_id: r.fingerprint for r in ws.signatures(docs, "text", ["doc_id"], samples=8, reach=reach).collect()}
    want, near, usual = of(None), of(4.0), of(ws.REACH)
    assert usual == want and all(near[k] in (None, v) for k, v in want.items()) and None in near.values()
    cols = ["doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    a, b = (sorted(tuple(r) for r in ws.edit_fingerprints(docs, samples=8, reach=x).select(cols).collect()) for x in (4.0, ws.REACH))
    assert a == b


def test_odd_rows(spark, odd, none):
    out = ws.edit_fingerprints(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and ws.edit_fingerprints(none).count() == 0
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert of[1][0].n_chars == 0 and of[1][0].fingerprint == "" and of[2][0].near_next in (0.0, 1.0)
    assert of[1][0].near_edited == 1.0 and of[3][0].fingerprint == ""  # white space only
    assert of[4][0].fingerprint == of[5][0].fingerprint == of[5][1].fingerprint and of[5][0] == of[5][1]
    assert of[6][0].fingerprint == of[7][0].fingerprint and of[6][0].near_next == 1.0
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    # Null ids come last; the last document's successor is the first.
    order = sorted((i for i in texts if i is not None)) + [None]
    edited = _edited([(i, texts[i]) for i in order])
    for i in order:
        assert of[i][0].edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest(), i


def test_one_document_succeeds_itself(spark):
    r = ws.edit_fingerprints(spark.createDataFrame([(7, "abcd efgh é")], "doc_id long, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcd efghab").hexdigest() and r.n_chars == 11
    assert r.near_next == 1.0


def test_weights_are_counts(spark):
    df = spark.createDataFrame([(1, "b a b  c\nb a"), (2, "")], "k long, t string")
    got = {(r.k, r.weight, r.total) for r in ws.terms(df, "t", ["k"]).collect()}
    assert got == {(1, 3, 6), (1, 2, 6), (1, 1, 6), (2, None, 0)}
    names = {r[0]: w for w in "abc" for r in spark.createDataFrame([(w,)], "w string").select(F.xxhash64("w")).collect()}
    assert {(names[r.term], r.weight) for r in ws.terms(df, "t", ["k"]).filter("k = 1").collect()} == {("b", 3), ("a", 2), ("c", 1)}


def test_no_python_on_the_main_path(spark):
    df = ws.op13_weighted_sampling(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
