"""SimHash, compact windows and suffix arrays against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from recount.llm import compact_windows as cw
from recount.llm import simhash, suffix_array
from recount.llm.components import connected_components
from tests.llm.conftest import SMALL


def _classes(nodes, joined):
    at = {n: n for n in nodes}

    def find(x):
        while at[x] != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    for a, b in joined:
        a, b = sorted((find(a), find(b)))
        at[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    links += [(2000, i) for i in range(2001, 2040)] + links[:5]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = _classes({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if s and 2 * sum(x >> b & 1 for x in h) > len(h))


def _check_simhash(rows, got):
    fps = [_fingerprint(t) for _, t in rows]
    u = sorted(set(fps))
    of = _classes(u, [(a, b) for i, a in enumerate(u) for b in u[i + 1 :] if (a ^ b).bit_count() <= 3])
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[of[f]] = min(i, least.get(of[f], i))
    want = Counter((i, format(f, "016x"), least.get(of[f])) for (i, _), f in zip(rows, fps))
    assert got == want


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in simhash.op2_simhash(spark, SMALL).select("doc_id", "fingerprint", "component_id").collect())
    _check_simhash([tuple(r) for r in docs], got)


def test_simhash_on_odd_texts(odd, none):
    from pyspark.sql import functions as F

    near = simhash.near_duplicates(odd).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    _check_simhash([tuple(r) for r in odd.select("doc_id", "text").collect()], Counter(tuple(r) for r in near.collect()))
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(ids, key=str) == sorted({r[2] for r in near.collect()}, key=str)  # one row of each component
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_links_find_every_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(6):
            x = b
            for bit in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bits in (0, 1, 3):
        got = sorted(tuple(sorted((r.a, r.b))) for r in simhash.links(df, bits).collect())
        want = sorted(tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= bits)
        assert got == want  # each pair once


def test_index_is_shuffled_once(spark):
    import contextlib
    import io

    from recount.llm.common import written

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = simhash.links(written(spark.range(5000).selectExpr("xxhash64(id) AS fp"), "fps"))
        found.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            found.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [x for x in out.getvalue().split("Initial Plan")[0].splitlines() if "Exchange hashpartitioning" in x]
    assert len(lines) == 2 and sum("ReusedExchange" in x for x in lines) == 1


def test_index_is_not_broadcast(spark, monkeypatch):
    from recount.llm.common import written
    from tests.conftest import plan_text

    # Fingerprints of under the 10 MB that Spark broadcasts, of which 35 times as many list entries are made.
    fps = written(spark.range(5000).selectExpr("xxhash64(id) AS fp"), "fps")
    found = simhash.links(fps)
    found.collect()
    plan = plan_text(found)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    plans = []
    monkeypatch.setattr(simhash, "connected_components", lambda links: plans.append(plan_text(links)) or connected_components(links))
    simhash.op2_simhash(spark, SMALL)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_fingerprints_beyond_a_chunk():
    rng = np.random.default_rng(2)
    for n in (simhash._CHUNK + 1, simhash._CHUNK + 2, simhash._CHUNK + 3, 2 * simhash._CHUNK + 700):
        words = [f"w{x}" for x in rng.integers(0, 5000, n)]
        assert simhash.fingerprint(" ".join(words).encode()) == _fingerprint(" ".join(words))


def test_compact_windows_stand_for_all_stretches():
    rng = np.random.default_rng(5)
    for _ in range(100):
        n, least = int(rng.integers(0, 60)), int(rng.integers(1, 8))
        h = rng.integers(0, 20, n).astype(np.uint64)
        nodes = list(zip(*cw.compact_windows(h, [0], [n], least)))
        for i in range(n):
            for j in range(i + least - 1, n):
                assert [c for a, c, b in nodes if a <= i <= c <= j <= b] == [i + int(np.argmin(h[i : j + 1]))]


def _passages(rows, links):
    toks = {i: cw.tokens((t or "").encode()) for i, t in rows}
    groups = defaultdict(set)
    for i, x in toks.items():
        for p in range(len(x) - 45):
            groups[x[p : p + 46].tobytes()].add(i)
    of = _classes(list(toks), [(r.doc_id, r.other_id) for r in links])
    texts = dict(rows)
    for g in groups.values():
        assert len({of[i] for i in g if len({texts[k] for k in g}) > 1 or True}) == 1  # every exact repeat is linked
    for r in links:
        a, b = (" ".join((texts[i] or "").lower().split()[x:y]) for i, x, y in ((r.doc_id, r.begin, r.end), (r.other_id, r.other_begin, r.other_end)))
        sa, sb = (set(cw.tokens(z.encode()).tolist()) for z in (a, b))
        assert r.similarity == pytest.approx(len(sa & sb) / len(sa | sb)) and r.similarity >= 0.8 and r.end - r.begin >= 50
    return groups


def test_passages_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    groups = _passages(docs, cw.op5_compact_windows(spark, SMALL).collect())
    assert any(len(g) > 1 for g in groups.values())


def test_passages_on_odd_and_near_texts(spark, odd, none):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(4000)]
    pick = lambda n: [vocabulary[i] for i in rng.integers(0, 4000, n)]
    shared = pick(120)
    rows = []
    for i in range(40):  # one word in 120 changed: similar, never equal
        mine = list(shared)
        mine[int(rng.integers(40, 80))] = vocabulary[i]
        rows.append((i, " ".join(pick(100) + mine + pick(80))))
    rows += [(100 + i, " ".join(pick(300))) for i in range(40)]
    links = cw.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = _classes([i for i, _ in rows], [(r.doc_id, r.other_id) for r in links])
    assert len({of[i] for i in range(40)}) == 1 and {r.doc_id for r in links} | {r.other_id for r in links} == set(range(40))
    assert len(links) < 40 * 30  # not all pairs
    got = cw.near_passages(odd).collect()
    assert {(9, 10)} <= {tuple(sorted((r.doc_id, r.other_id))) for r in got}
    assert cw.near_passages(none).count() == 0


def _cut(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        c = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], c.astype(int)))) == 1).sum())
        out.append((len(t), int(c.sum()), spans, np.frombuffer(t, np.uint8)[~c].tobytes()))
    return out


def test_suffix_order_and_repeats():
    rng = np.random.default_rng(1)
    for k in range(60):
        n, length = int(rng.integers(1, 400)), int(rng.integers(5, 40))
        b = rng.integers(0, 2, n).astype(np.uint8) if k % 2 else np.tile(rng.integers(0, 3, int(rng.integers(1, 30))), 50)[:n].astype(np.uint8)
        raw, n = b.tobytes(), len(b)
        starts = range(max(0, n - length + 1))
        assert [raw[i : i + length] for i in suffix_array.refine(b, length) if i + length <= n] == sorted(raw[i : i + length] for i in starts)
        is_start = np.zeros(n, bool)
        is_start[: len(starts)] = True
        count = Counter(raw[i : i + length] for i in starts)
        assert suffix_array.repeated(b, is_start, length)[: len(starts)].tolist() == [count[raw[i : i + length]] > 1 for i in starts]


def test_common_prefixes_of_scattered_starts():
    """Chains of neighbours that go on past a difference."""
    rng = np.random.default_rng(7)
    for k in range(200):
        length = int(rng.integers(5, 30))
        words = [rng.integers(97, 100, int(rng.integers(20, 90))).astype(np.uint8) for _ in range(3)]
        parts = [words[i] for i in rng.integers(0, 3, 6)]
        b = np.concatenate([np.concatenate((x, rng.integers(97, 123, int(rng.integers(1, 9))).astype(np.uint8))) for x in parts])
        raw, n = b.tobytes(), len(b)
        is_start = np.zeros(n, bool)
        is_start[: n - length + 1] = rng.random(n - length + 1) < (0.3, 0.9, 1)[k % 3]
        starts = np.flatnonzero(is_start).tolist()
        count = Counter(raw[i : i + length] for i in starts)
        assert [i for i in starts if count[raw[i : i + length]] > 1] == np.flatnonzero(suffix_array.repeated(b, is_start, length)).tolist()


def test_suffix_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, r, s, hashlib.sha256(k).hexdigest()) for (i, _), (n, r, s, k) in zip(docs, _cut([(t or "").encode() for _, t in docs], 400))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_array.op6_suffix_array(spark, SMALL).collect()}
    assert got == want and any(x[1] for x in want.values())


def test_suffix_on_odd_texts(odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    want = Counter((i, k.decode("utf-8", "ignore")) for (i, _), (_, _, _, k) in zip(rows, _cut([(t or "").encode() for _, t in rows], 60)))
    got = suffix_array.without_repeats(odd, length=60)
    assert got.columns == [*odd.columns, "__kept_text"]
    assert Counter(tuple(r) for r in got.select("doc_id", "__kept_text").collect()) == want
    assert suffix_array.without_repeats(none).count() == 0


def test_repeats_across_hashed_pieces(spark, monkeypatch):
    """Passages that lie across the border of what is hashed at a time."""
    monkeypatch.setattr(suffix_array, "CHUNK", 1000)
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = letters(450)
    rows = [(i, letters(at) + passage + letters(700)) for i, at in enumerate((0, 550, 600, 780, 990, 1000, 1399, 2600))] + [(90, letters(5000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, suffix_array.without_repeats(docs).select("doc_id", "__kept_text").collect()))
    assert got == {i: k.decode() for (i, _), (*_, k) in zip(rows, _cut([t.encode() for _, t in rows], 400))}
    assert all(passage not in t for t in got.values())


def test_passages_go_from_400_bytes_on(spark):
    """Passages of 51 to 110 words put into documents: those of 400 bytes or more go whole from every
    document, shorter ones stay (the contract's length); documents without one are as they were."""
    rng = np.random.default_rng(6)
    vocabulary = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 11, 3000)]
    words = lambda n: " ".join(vocabulary[i] for i in rng.integers(0, 3000, n))
    rows, passages, clean = [], [], []
    for n in range(51, 111):
        passage = f"<{words(n)}>"
        passages.append(passage)
        rows += [(len(rows) + k, f"{words(80)} {passage} {words(60)}") for k in range(3)]
    clean = [(1000 + k, words(200)) for k in range(50)]
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string")
    got = dict(map(tuple, suffix_array.without_repeats(docs).select("doc_id", "__kept_text").collect()))
    assert all(got[i] == t for i, t in clean)
    for i, t in rows:
        p = passages[i // 3]
        # The spaces around a passage are equal as well: a repeat has two bytes more.
        assert (p in got[i]) == (len(p) + 2 < 400) and (got[i] == t) == (len(p) + 2 < 400)
    assert 0.4 < np.mean([len(p) + 2 >= 400 for p in passages]) < 0.95


def test_hot_value_over_many_shards(spark, monkeypatch):
    """Shards of 2 KB: the slices of a shared passage lie in many of them and are merged."""
    monkeypatch.setattr(suffix_array, "SHARD", 1 << 11)
    rng = np.random.default_rng(4)
    common = bytes(rng.integers(97, 123, 150).tolist()).decode()
    texts = [bytes(rng.integers(97, 123, 60).tolist()).decode() + common + bytes(rng.integers(97, 123, 60).tolist()).decode() for _ in range(80)]
    texts += ["ab" * 300, "ab" * 41, common, common]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["__kept_text"] for r in suffix_array.without_repeats(df, length=80).collect()}
    assert got == {i: k.decode() for i, (_, _, _, k) in enumerate(_cut([t.encode() for t in texts], 80))}


def test_suffix_stretches_of_one_period(spark):
    """Periods up to beyond the length, among them the one whose smallest hash stands in no two
    places of a window although one run holds all of the stretch."""
    rng, length = np.random.default_rng(11), 60
    word = lambda n: bytes(rng.integers(97, 123, n).tolist()).decode()
    texts = []
    for period in range(length // 4, length + 2):
        texts += [word(90) + (word(period) * 8)[: int(k * period) + length] + word(90) for k in (1.4, 3)]  # no record in two texts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["__kept_text"] for r in suffix_array.without_repeats(df, length=length).collect()}
    assert got == {i: k.decode() for i, (_, _, _, k) in enumerate(_cut([t.encode() for t in texts], length))}


def test_unlike_neighbours_in_a_signature(spark):
    """A text that neither the first nor its predecessor of a group is similar to, but a further one."""
    rows = [(s, e, p, t, t) for s, e, p, t in [(1, 0, 5, 1), (1, 1, 5, 2), (1, 2, 5, 3), (1, 3, 5, 4), (2, 0, 5, 1), (2, 1, 5, 2)]]
    signed = spark.createDataFrame(rows, "sig long, extra long, place int, __t1 long, __t2 int")
    schema = "x1 long, x2 int, y1 long, y2 int, " + cw.LINKS
    link = lambda x, y, at: (x, x, y, y, at, at + 60, at, at + 60, 0.9)
    pairs = lambda links: {(r.a.t1, r.b.t1) for r in cw.unlinked_pairs(signed, spark.createDataFrame(links, schema)).collect()}
    assert pairs([]) == {(a, b) for a in range(1, 5) for b in range(a + 1, 5)}
    assert pairs([link(1, 2, 0), link(2, 3, 3)]) == {(1, 4), (2, 4), (3, 4)}  # overlapping in 2
    assert pairs([link(1, 2, 0), link(2, 3, 0), link(2, 4, 900)]) == {(1, 4), (2, 4), (3, 4)}  # 4 is linked elsewhere only


def test_classes_of_passages(spark, odd):
    rng = np.random.default_rng(9)
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, 6))
    pick = lambda n: [word() for _ in range(n)]
    mid = pick(60)

    def changed(k):  # the first k and the last 60 - k words differ ever more: a chain of similar neighbours
        return pick(k) + mid[k:]

    rows = [(i, " ".join(pick(20) + (changed(i // 2) if i % 2 else mid[: 60 - i // 2] + pick(i // 2)) + pick(20))) for i in range(30)]
    toks = {i: cw.tokens(t.encode()) for i, t in rows}
    links = cw.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.class_id, r.n_links) for r in cw.document_classes(links).collect()}
    links = links.collect()
    of = _classes(list(toks), [(r.doc_id, r.other_id) for r in links])
    n = Counter(i for r in links for i in (r.doc_id, r.other_id))
    assert got == {i: (of[i], n[i]) for i in n} and all(r.class_id == of[r.doc_id] for r in links)
    # Whatever shares all signatures at some place (a brute-force link at 1.0) is in one class.
    for i in toks:
        for j in toks:
            if i < j and any(s >= 0.999 for *_, s in cw.similar_passages(toks[i], toks[j])):
                assert of[i] == of[j]
    assert {r.class_id for r in cw.near_passages(odd).collect() if r.doc_id == 10 or r.other_id == 10} == {9}


def _signatures(*texts):
    """The signatures of each text (token arrays), all values taken as shared."""
    toks, n = np.concatenate(texts), np.array([len(x) for x in texts])
    starts = np.cumsum(n) - n
    hashes = [cw.min_hash(toks, j) for j in range(cw.HASHES)]
    known = np.repeat(np.arange(len(texts)), cw.HASHES * n), np.concatenate([h[a : a + k] for a, k in zip(starts, n) for h in hashes])
    of, sig, _, place = cw.signatures(cw.shared_windows(toks, starts, known, 46), toks, starts, 46)
    assert ((place >= 0) & (place < n[of])).all()
    return [set(sig[of == i].tolist()) for i in range(len(texts))]


def test_passages_that_stand_several_times_in_a_text():
    rng = np.random.default_rng(13)
    pick = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for k in (2, 5, 10):
        for _ in range(40):
            p = pick(50)
            many = np.concatenate([z for _ in range(k) for z in (pick(int(rng.integers(30, 80))), p)])
            a, b = _signatures(many, np.concatenate((pick(60), p, pick(60))))
            assert len(a & b) >= 6  # all six pairs of functions, always


def test_leading_windows_lose_no_signature(monkeypatch):
    rng = np.random.default_rng(14)
    for k in range(60):
        toks = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        words = [toks[rng.integers(0, (3, 40)[k % 2], int(rng.integers(1, 70)))] for _ in range(3)]
        text = np.concatenate([words[i] for i in rng.integers(0, 3, int(rng.integers(2, 9)))])
        got = _signatures(text, toks)
        with monkeypatch.context() as m:
            m.setattr(cw, "leading", lambda of, v, *_: np.ones(len(v), bool))
            m.setattr(cw, "PAIRS", (50, 1 << 22)[k % 2])
            assert got == _signatures(text, toks)
    one = toks[:1].repeat(20_000)
    assert _signatures(one, one[:60])[0] == _signatures(one, one[:60])[1]


def test_every_place_of_a_passage():
    rng = np.random.default_rng(15)
    pick = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    p = pick(60)
    x = np.concatenate((pick(90), p, pick(40)))
    y = np.concatenate((pick(20), p, pick(70), p, pick(70), p))
    assert [q[:4] for q in cw.similar_passages(x, y)] == [(90, 154, a, a + 64) for a in (20, 150, 280)]


def test_repeats_within_a_text():
    rng = np.random.default_rng(16)
    pick = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for k in range(200):
        p, before, between = pick(int(rng.integers(46, 200))), int(rng.integers(0, 90)), int(rng.integers(0, 90)) * (k % 3)
        near = p.copy()
        if k % 2:  # two words changed, not those at the ends
            for at in (len(p) // 3, 2 * len(p) // 3):
                near[at : at + 2] = pick(2)
        text = np.concatenate((pick(before), p, pick(between), near, pick(30)))
        assert [q[:4] for q in cw.own_repeats(text)] == [(before, before + len(p) + 4, before + between + len(p), before + between + 2 * len(p) + 4)]
    assert cw.own_repeats(pick(3000)) == [] and cw.own_repeats(pick(0)) == [] and cw.own_repeats(pick(50)) == []
    for period in (1, 7, 100):
        found = cw.own_repeats(np.tile(pick(period), 600 // period))
        assert found and all(q[1] - 4 <= q[2] and q[4] >= 0.8 for q in found)


def test_repeats_within_a_text_query(spark):
    rng = np.random.default_rng(17)
    pick = lambda n: ["".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(n)]
    p = pick(70)
    rows = [(1, " ".join(pick(40) + p + pick(90) + p + pick(40))), (2, " ".join(pick(300))), (None, " ".join(pick(100) * 2))]
    links = cw.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.class_id, r.n_links) for r in cw.document_classes(links).collect()} == {(1, 1, 1)}
    assert sorted((r.begin, r.end, r.other_begin, r.other_end) for r in links.filter("doc_id = other_id").collect()) == [(40, 110, 200, 270)]
    assert links.filter("doc_id IS NULL").count() == 1


def test_texts_of_a_signature_that_share_a_sentence_only(spark, monkeypatch):
    """Of a group only the pairs that can hold a similar passage are verified, whichever cells they fall into."""
    rng = np.random.default_rng(19)
    pick = lambda n: ["".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(n)]
    sentence, passage = pick(20), pick(60)
    rows = [(i, i, " ".join(pick(50) + sentence + pick(50) + (passage if i % 6 == 0 else [])).encode()) for i in range(1, 25)]
    texts = cw.stored_texts(spark.createDataFrame(rows, "__t1 long, __t2 int, __text binary"))
    signed = spark.createDataFrame([(1, 0, 55, i, i) for i, *_ in rows], "sig long, extra long, place int, __t1 long, __t2 int")
    links = spark.createDataFrame([], "x1 long, x2 int, y1 long, y2 int, " + cw.LINKS)
    for cell in (512, 5):
        monkeypatch.setattr(cw, "CELL", cell)
        pairs = [(r.a.t1, r.b.t1) for r in cw.unlinked_pairs(signed, links, texts).collect()]
        assert sorted(pairs) == [(a, b) for a in (6, 12, 18, 24) for b in (6, 12, 18, 24) if a < b]
        assert cw.unlinked_pairs(signed, links).count() == 24 * 23 // 2


def test_common_pairs():
    rng = np.random.default_rng(20)
    for k in range(40):
        texts = [rng.integers(0, (60, 400, 5000)[k % 3], int(rng.integers(0, 150))).astype(np.uint64) for _ in range(30)]
        c, s = rng.integers(0, 5, 30), rng.integers(0, 1 + k % 2, 30)
        many = lambda i, j: np.isin(texts[i], texts[j]).sum() > 33 and np.isin(texts[j], texts[i]).sum() > 33
        want = [(i, j) for i in range(30) for j in range(i + 1, 30) if c[i] != c[j] and (s.max() == 0 or s[i] != s[j]) and many(i, j)]
        assert cw.common_pairs([(np.arange(30), c, s)], texts, 33) == want


def test_pairs_linked_by_way_of_others(spark, monkeypatch):
    """Texts of a group that hold one linked passage are not verified again for that passage, only for what else they may share."""
    rng = np.random.default_rng(23)
    pick = lambda n: ["".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(n)]
    sentence, passage, other = pick(20), pick(70), pick(60)
    rows = [(i, i, " ".join(pick(50) + sentence + pick(50) + passage + pick(10) + (other if i % 8 == 0 else [])).encode()) for i in range(1, 25)]
    rows.append((25, 25, " ".join(passage + pick(10) + sentence + passage + passage).encode()))  # repeats itself: compared whole
    texts = cw.stored_texts(spark.createDataFrame(rows, "__t1 long, __t2 int, __text binary"))
    signed = spark.createDataFrame([(1, 0, 55 if i < 25 else 85, i, i) for i, *_ in rows], "sig long, extra long, place int, __t1 long, __t2 int")
    links = [(1, 1, i, i, 120, 190, 120 if i < 25 else 100, 190 if i < 25 else 240, 1.0) for i in range(2, 26)]
    links = spark.createDataFrame(links, "x1 long, x2 int, y1 long, y2 int, " + cw.LINKS)
    for cell in (512, 5):
        monkeypatch.setattr(cw, "CELL", cell)
        pairs = sorted((r.a.t1, r.b.t1) for r in cw.unlinked_pairs(signed, links, texts).collect())
        assert pairs == sorted([(8, 16), (8, 24), (16, 24)] + [(i, 25) for i in range(1, 25)])


def test_common_pairs_by_class():
    rng = np.random.default_rng(24)
    for k in range(40):
        texts = [rng.integers(0, (60, 400)[k % 2], int(rng.integers(0, 150))).astype(np.uint64) for _ in range(20)]
        labels = [rng.integers(-1, (1, 3)[k % 3 > 0], len(x)) for x in texts]

        def more(i, j):
            there = [set(labels[j][texts[j] == t].tolist()) for t in texts[i]]
            return sum(bool(at) and (at != {x} or x < 0) for at, x in zip(there, labels[i].tolist())) > 20

        want = [(i, j) for i in range(20) for j in range(i + 1, 20) if more(i, j) and more(j, i)]
        assert cw.common_pairs([(np.arange(20), np.arange(20), np.zeros(20, int))], texts, 20, labels) == want
        assert len(cw.common_pairs([(np.arange(20), np.arange(20), np.zeros(20, int))], texts, 20)) >= len(want)


def test_dense_pairs():
    rng = np.random.default_rng(25)
    least, kept = 20, 0
    for k in range(30):
        base = rng.integers(0, 1 << 40, 90)
        texts, labels = [], []
        for _ in range(12):
            x = np.where(rng.random(90) < rng.choice([0.05, 0.2, 0.5]), rng.integers(0, 1 << 40, 90), base)
            if k % 3 == 0:
                x[rng.integers(0, 90, 12)] = x[5]
            texts.append(x[rng.integers(0, 30) : 90 - rng.integers(0, 50)].astype(np.uint64))
            labels.append(np.repeat(rng.integers(-1, 2, 9), 10)[: len(texts[-1])])
        pairs = [(i, j) for i in range(12) for j in range(i + 1, 12)]
        shares = [cw.shares(x, 0.8, least) for x in texts]
        for of in (labels, [np.full(len(x), -1) for x in texts]):

            def best(i, j):
                there = [set(of[j][texts[j] == t].tolist()) for t in texts[i]]
                hit = [bool(at) and (at != {x} or x < 0) for at, x in zip(there, of[i].tolist())]
                return max([sum(hit[a:b]) / (b - a) for a in range(len(hit)) for b in range(a + least, len(hit) + 1)], default=-1) + 1e-6

            def fits(i, j):
                p, q = best(i, j), best(j, i)
                return p >= shares[i][0] and q >= shares[j][0] and (p >= shares[i][1] or q >= shares[j][1])

            want = [p for p in pairs if fits(*p)]
            assert cw.dense_pairs(pairs, texts, shares, least, of) == want
            kept += len(want)
    assert 0 < kept < 30 * 2 * len(pairs) and cw.dense_pairs([], [], [], least) == []


def test_no_similar_pair_is_left_out():
    """Of texts that are not linked yet, every pair in which verification finds a passage is a candidate."""
    rng = np.random.default_rng(26)
    linked = 0
    for k in range(60):
        base = rng.integers(0, 1 << 40, 130).astype(np.uint64)
        if k % 4 == 0:
            base[rng.integers(0, 130, 40)] = base[rng.integers(0, 5, 40)]
        texts = []
        for _ in range(2):
            x = np.where(rng.random(130) < rng.choice([0.02, 0.08, 0.15]), rng.integers(0, 1 << 40, 130).astype(np.uint64), base)
            texts.append(np.concatenate((rng.integers(0, 1 << 40, 20).astype(np.uint64), x, rng.integers(0, 1 << 40, 20).astype(np.uint64))))
        if cw.similar_passages(*texts):
            linked += 1
            assert cw.dense_pairs([(0, 1)], texts, [cw.shares(x, 0.8, 46) for x in texts], 46) == [(0, 1)]
    assert linked > 20


def test_tokens_of_odd_words():
    words = [b"", b"a", b"a\0", b"a\0\0", b"b" * 8, b"b" * 9, b"c" * 63, b"c" * 64, b"c" * 65, b"c" * 64 + b"d", b"\x85", b"\x1c", b"\xc3\xa9"]
    odd = [cw.tokens(w + b" x y\tz \x0bq\r\n") for w in words]
    assert [len(x) for x in odd] == [0] + [1] * (len(words) - 1)
    assert len({int(x[0]) for x in odd[1:]}) == len(words) - 1
    assert (cw.tokens(b"A b C d E f") == cw.tokens(b" a\nB c\x0cD  e F ")).all()
