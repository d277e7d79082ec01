"""Packing, byte pairs, token files, archives, top-k: brute force, round trips, odd input."""

import base64
import hashlib
import io
import random
import re
import struct
import zipfile
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recount.llm import bpe, lexicon, packing, simple8b, token_ids, topk, warc
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


# --- packing ----------------------------------------------------------------------------------


def test_best_fit_is_the_tightest_compatible():
    """Replayed against all open bins: each piece lies in the tightest that it fits and may enter."""
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(0, 300))
        rows = [(i, int(rng.integers(1, 90)), [None, 1, 2, 3, *range(4, 40)][int(rng.integers(0, 40))], [None, *range(60)][int(rng.integers(0, 61))]) for i in range(n)]
        rows.sort(key=lambda r: -(r[1] % 32))
        of = {r[0]: r for r in rows}
        left, sources, clusters = {}, {}, {}
        got = packing.pack_shard(rows, 32)
        assert [(i, k) for i, k, *_ in got] == [(r[0], k) for r in rows for k in range(-(-r[1] // 32))]
        for i, _, size, b, at in got:
            _, _, s, c = of[i]
            fit = [left[x] for x in left if left[x] >= size and (s is None or s not in sources[x]) and (c is None or c not in clusters[x])]
            if size == 32 or not fit:
                assert b not in left and at == 0
                left[b], sources[b], clusters[b] = 32, set(), set()
            assert left[b] == 32 - at and (not fit or size == 32 or left[b] == min(fit))
            assert not ({s} & sources[b] - {None} or {c} & clusters[b] - {None})
            left[b] -= size
            sources[b].add(s)
            clusters[b].add(c)


def _check_bins(df, rows, capacity):
    got = packing.best_fit(df, capacity=capacity).collect()
    of = {}
    for i, text, source in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        of.setdefault(i, []).append((len(w) + 1, source, tuple(w) or None))
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {i: sum(x[0] for x in v) for i, v in of.items()}
    bins: dict = {}
    for r in sorted(got, key=lambda r: r.bin_offset):
        assert sum(x.n_tokens for x in bins.get(r.bin_id, [])) == r.bin_offset
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        assert sum(x.n_tokens for x in b) <= capacity
        for k in (1, 2):
            held = [of[x.doc_id][0][k] for x in b if of[x.doc_id][0][k] is not None]
            assert len(held) == len(set(held))
    return got


def test_packing_of_odd_texts(odd, none):
    got = _check_bins(odd, [tuple(r) for r in odd.select("doc_id", "text", "source").collect()], 2048)
    assert len(got) > odd.count() and packing.best_fit(none).count() == 0


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert packing.op4_packing(spark, SMALL).count() == len(_check_bins(docs, rows, 2048))
    by_length = packing.best_fit(docs.withColumn("n", F.lit(3)), length="n", cluster="lang", source=None, capacity=9).collect()
    assert {r.n_tokens for r in by_length} == {3}


# --- byte pairs -------------------------------------------------------------------------------

ODD = [
    "", " ", "Hello <|endoftext|> world", "it's we've I'LL don't", "ÀÉÎ õüß İstanbul ſ ǅ 12³½ ©®\xa0x\x85y", "a" * 3000, "!!!???...",
    "日本語 тест é", "\x1c\x1d a", "''''s's", "ŉ Ǆ Ÿ", "\x7f\x00 ctrl", "<|startoftext|>", "soft\xadhyphen",
]


def test_encoder_equals_the_library(spark, library):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab'sST 1²éÀŁ\n\t.!<|>ıİ") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    plain = bpe.Encoder(PATH)
    words = sorted({w.encode() for t in texts[:900] for w in plain.words.findall(t.lower())})
    lex = lexicon.Lexicon(lexicon.build(words, bpe.Encoder(PATH).ids_of_words([w.decode() for w in words])))
    want = library.encode_batch(texts, add_special_tokens=False)
    for encoder in (plain, bpe.Encoder(PATH, lex), bpe.Encoder(PATH, by_library=True)):
        got = encoder.ids(texts)
        assert [x.tolist() for x in got] == [w.ids for w in want]
        assert [encoder.decode(x) for x in got[:900]] == [library.decode(w.ids, skip_special_tokens=False) for w in want[:900]]


def test_safe_pieces_are_not_searched_one_by_one(library):
    encoder = bpe.Encoder(PATH, by_library=True)
    unsafe, calls = encoder.unsafe, []

    class Counted:
        def search(self, text):
            calls.append(text)
            return unsafe.search(text)

    encoder.unsafe = Counted()
    safe = [" ".join(f"Word{i}'s {i * 7} naïve-{i}" for i in range(at, at + 300)) for at in range(0, 900, 300)]
    for texts in (safe, ["мир один", *safe, "word5's <|endoftext|>x 日本 word6's"], ["", "one new"]):
        assert [x.tolist() for x in encoder.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        if texts is safe:
            assert len(calls) == len(texts) + 1
    assert sorted(encoder.table.values()) == list(range(len(encoder.first)))


def test_lexicon_is_minimal_and_exact():
    rng = random.Random(1)
    words = sorted({("".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) + rng.choice(["", "ing", "tion"])).encode() for _ in range(3000)})
    ids = [[i % 60000, len(w)] for i, w in enumerate(words)]
    lex = lexicon.Lexicon(lexicon.build(words, ids))
    asked = words + [w + b"x" for w in words[:50]] + [b"z", b"in"]
    flat = np.frombuffer(b"".join(asked), np.uint8)
    size = np.array(list(map(len, asked)))
    got = lex.numbers(flat, np.cumsum(size) - size, size)
    known = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [known.get(w, -1) for w in asked]
    assert [lex.ids[lex.first_id[i] : lex.first_id[i + 1]].tolist() for i in got[: len(words)]] == ids
    # Minimal: no two states accept the same endings.
    ends: dict = {}

    def endings(s):
        if s not in ends:
            out = {b""} if lex.final[s] else set()
            for a in range(lex.states[s], lex.states[s + 1]):
                out |= {bytes([lex.labels[a]]) + e for e in endings(int(lex.targets[a]))}
            ends[s] = frozenset(out)
        return ends[s]

    endings(lex.root)
    assert len(ends) == len(set(ends.values())) == len(lex.final)
    assert len(lexicon.Lexicon(lexicon.build([], []))) == 0


def test_bpe_query_and_odd_texts(spark, library, odd, none):
    def digests(rows):
        out = {}
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            out[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        return out

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in bpe.op3_bpe(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    assert got == digests([tuple(r) for r in docs.select("doc_id", "text").collect()])
    uri = bpe.build_lexicon(odd, PATH)
    rows = bpe.encoded(odd, PATH, uri, [F.col("doc_id"), F.col("__id")]).collect()
    want = digests([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert len(rows) == odd.count() and all(hashlib.sha256(r.ids).hexdigest() == want[r.doc_id][1] for r in rows)
    assert bpe.encoded(none, PATH, bpe.build_lexicon(none, PATH), [F.col("doc_id")]).count() == 0


# --- token files ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 3000])
def test_simple8b_round_trip(n):
    rng = np.random.default_rng(n)
    for most in (0, 1, 2, 100, 50_000, 1 << 31, 1 << 59, (1 << 60) + 7, (1 << 64) - 1):
        v = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
        if n > 700:
            v[100:400] = 0
        w, first = simple8b.encode(v)
        assert (simple8b.decode(w) == v).all() and len(first) == -(-n // simple8b.BLOCK) + 1
        for b in range(len(first) - 1):
            assert (simple8b.decode(w[first[b] : first[b + 1]]) == v[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]).all()


def test_words_take_as_many_values_as_fit():
    w, _ = simple8b.encode(np.full(60, 1, np.uint64))
    assert w.tolist() == [2 << 60 | (1 << 60) - 1]
    w, _ = simple8b.encode(np.array([49407, 2, 49406], np.uint64))
    assert w.tolist() == [13 << 60 | 49406 << 40 | 2 << 20 | 49407]


def test_file_of_many_pieces(monkeypatch):
    monkeypatch.setattr(token_ids, "PIECE", 1024)
    rng = np.random.default_rng(2)
    docs = [(None if i == 0 else i, rng.integers(0, 50_000, int(rng.integers(0, 3000))).astype(np.uint64)) for i in range(30)]
    f = io.BytesIO()
    w = token_ids.Writer(f)
    for i, ids in docs:
        w.add(i, ids)
    w.close()
    r = token_ids.Reader(f, len(f.getvalue()))
    flat = np.concatenate([x for _, x in docs])
    want, at = [], 0
    for i, x in docs:
        want.append((i, at, len(x), zlib.crc32(x.astype("<u4").tobytes())))
        at += len(x)
    assert list(r.documents()) == want
    for a, b in ((0, 0), (0, 1), (511, 513), (700, 5000), (at - 1, at)):
        assert (r.values(a, b) == flat[a:b]).all()


def test_token_query_and_odd_texts(spark, library, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, at = [], 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = token_ids.op10_token_ids(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(tuple(r) for r in got) == want
    rows = token_ids.read_tokens(token_ids.write_tokens(odd, PATH, files=3)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd.collect()), key=lambda x: (x is not None, x))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert token_ids.read_tokens(token_ids.write_tokens(none, PATH)).count() == 0


# --- archives ---------------------------------------------------------------------------------


def _duck(table, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS FROM '{SMALL}/{table}.parquet'")
    rel = con.sql(sql)
    return rel.columns, sorted(map(str, rel.fetchall()))


def test_warc_query_equals_sql(spark):
    columns, want = _duck("pages", warc.WARC_SQL)
    got = warc.op1_warc(spark, SMALL).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_revisits_and_odd_pages(spark):
    rows = [(1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (3, "http://c/é", "same"), (4, "u", None), (5, "u", ""), (None, "u", "same"),
            (None, "u", "null ids"), (None, "u", "null ids"), (6, "u", "x" * 300_000), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "WARC/1.1\r\n\r\n\r\n")]
    pages = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, first int, digest string")
    got = warc.read_packages(warc.write_packages(pages)).collect()

    def want(i, html):
        same = [k for k, _, h in rows if (h or "") == (html or "")]
        first = max((k for k in same if k is not None), default=None)
        again = first is not None and (i is None or i < first)
        d = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        return (i, len((html or "").encode()), d, "revisit" if again else "response", first if again else None)

    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(str(want(i, h)) for i, _, h in rows)
    urls = {r.page_id: r.url for r in got}
    assert urls[1] == "http://a/%20b%0D%0AX:%20y" and urls[2] is None and urls[3] == "http://c/%C3%A9"
    large = warc.read_packages(warc.write_packages(pages, min_bytes=10)).collect()
    assert {r.record_type for r in large if r.page_id in (1, 2, 3, 4, 5)} == {"response"}
    assert warc.read_packages(warc.write_packages(pages.filter("false"))).count() == 0


def test_zip_directories():
    f = io.BytesIO()
    p = warc.Package(f)
    raws = [warc.record(i, "u", b"payload %d" % i, None, False) for i in range(50)]
    for i, r in enumerate(raws):
        p.add(i, r)
    p.close()
    data = f.getvalue()
    import gzip

    def check(data):
        g = io.BytesIO(data)
        found = warc.locate(g, len(data))
        assert [gzip.decompress(data[a : a + n]) for a, n in found] == raws

    check(data)
    assert zipfile.ZipFile(io.BytesIO(data)).namelist() == [warc.MEMBER, warc.INDEX]
    # The same directory in ZIP64 form, as of a package beyond four GiB, and with a comment.
    end = data.rfind(b"PK\x05\x06")
    count, size, offset = struct.unpack("<HII", data[end + 10 : end + 20])
    central, at = b"", offset
    for _ in range(count):
        head = bytearray(data[at : at + 46])
        n, m, k = struct.unpack("<HHH", head[28:34])
        name, packed, plain, local = data[at + 46 : at + 46 + n], *struct.unpack("<II", head[20:28]), struct.unpack("<I", head[42:46])[0]
        head[20:28], head[42:46] = b"\xff" * 8, b"\xff" * 4
        extra = struct.pack("<HHQQQ", 1, 24, plain, packed, local)
        head[30:32] = struct.pack("<H", len(extra))
        central += bytes(head) + name + extra
        at += 46 + n + m + k
    wide = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(central), offset)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, offset + len(central), 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 5) + b"notes"
    check(data[:offset] + central + wide + locator + tail)
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.ZipDirectory(io.BytesIO(data[:100]), 100)
    g = io.BytesIO()
    with zipfile.ZipFile(g, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc.MEMBER, "x" * 100)
    with pytest.raises(ValueError, match="not stored"):
        warc.ZipDirectory(g, len(g.getvalue())).stored(warc.MEMBER)


def _package(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_packages_of_several_archives_and_indexes(spark, tmp_path, monkeypatch):
    import gzip
    import json

    raws = {i: warc.record(i, f"http://p/{i}", b"payload %d " % i * (3 * i), None, False) for i in range(1, 40)}
    foreign = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"

    def archive(ids, plain=False):
        data, places = b"", {}
        for i in ids:
            one = raws.get(i, foreign) if plain else gzip.compress(raws.get(i, foreign))
            places[i] = (len(data), len(one))
            data += one
        return data, places

    def lines(name, places):
        return "".join(f"k 2020 {json.dumps({'offset': str(a), 'length': n, **({'filename': name} if name else {})})}\n" for a, n in places.values()).encode()

    a, at_a = archive(range(1, 11))
    b, at_b = archive(range(11, 21), plain=True)
    c, at_c = archive([*range(21, 40), None])
    d, _ = archive([None, 1, 2], plain=True)
    _package(tmp_path / "one.wacz", {
        "archive/a.warc.gz": a, "archive/b.warc": b, "archive/c.warc.gz": c, "archive/d.warc": d, "pages/pages.jsonl": b"{}",
        "indexes/x.cdxj": lines("a.warc.gz", at_a) + b"\n",
        "indexes/y.cdx.gz": gzip.compress(b'!meta 0 {"format": "x"}\n') + gzip.compress(lines("archive/b.warc", at_b) + lines("a.warc.gz", at_a)),
    })
    _package(tmp_path / "two.wacz", {"archive/only.warc.gz": a, "indexes/i.cdxj": lines(None, at_a)})
    uris = spark.createDataFrame([(f"file://{tmp_path}/{n}.wacz",) for n in ("one", "two")], "uri string")
    want = sorted([*range(1, 11)] * 2 + [*range(11, 40)] + [1, 2])
    for piece in (warc.SCAN_BYTES, 7):  # pieces that cut lines, headers and records anywhere
        monkeypatch.setattr(warc, "SCAN_BYTES", piece)
        with open(tmp_path / "one.wacz", "rb") as f:
            data = f.read()
            found = warc.locate(f, len(data))
        parsed = [warc.parse(gzip.decompress(x) if x[:2] == b"\x1f\x8b" else x) for x in (data[p : p + n] for p, n in found)]
        assert len(parsed) == 43 and sum(r["warc-type"] == "resource" for r in parsed) == 2
    got = warc.read_packages(uris).collect()
    assert sorted(r.page_id for r in got if r.page_id is not None) == want
    others = [r for r in got if r.page_id is None]
    assert [tuple(r)[1:] for r in others] == [(3, base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), "resource", None, None)] * 2
    assert all(r.payload_bytes == len(b"payload %d " % r.page_id) * 3 * r.page_id and r.url == f"http://p/{r.page_id}" for r in got if r.page_id is not None)
    _package(tmp_path / "bad.wacz", {"archive/a.warc.gz": a[:-5]})
    _package(tmp_path / "lost.wacz", {"archive/a.warc.gz": a, "indexes/i.cdxj": lines("z.warc.gz", at_a)})
    for name, message in (("bad", "cut off"), ("lost", "no archive")):
        with open(tmp_path / f"{name}.wacz", "rb") as f, pytest.raises(ValueError, match=message):
            warc.locate(f, (tmp_path / f"{name}.wacz").stat().st_size)


# --- top-k ------------------------------------------------------------------------------------


def test_topk_query_equals_sql(spark):
    columns, want = _duck("embeddings", topk.TOPK_SQL)
    got = topk.op9_topk(spark, SMALL).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_topk_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 2]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5), (None, [9.0] * 5), (304, []), (305, [1.0, 2.0]), (400, [1.0, -2.0]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, v int, score string")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=10).collect())
    fine = [(i, np.floor(1024 * np.array(v, float))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for i, q in fine:
        if i % 100 == 0:
            best = sorted((-int(q @ v), k) for k, v in fine if k != i and len(v) == len(q))[:10]
            want += [(i, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert got == sorted(want) and sum(r[0] == 400 for r in got) == 1
    assert topk.top_k(df.filter("false"), F.lit(True)).count() == 0


def test_search_reads_few_exact_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 3000
    x = np.floor(centres[rng.integers(0, 40, 4096)] + rng.normal(size=(4096, 16)) * 200)
    borders = np.quantile(x, np.arange(1, 16) / 16, axis=0).T
    codes = np.stack([np.searchsorted(borders[i], x[:, i], side="right") for i in range(16)], axis=1)
    low = np.stack([[x[codes[:, d] == c, d].min() for c in range(16)] for d in range(16)])
    high = np.stack([[x[codes[:, d] == c, d].max() for c in range(16)] for d in range(16)])
    ids = np.arange(4096)
    s = topk.Search(ids[:20], x[:20], 10)
    s.block(ids, codes, np.stack((low, high)), x)
    want = [(i, int(k), int(x[i] @ x[k])) for i in range(20) for k in sorted((j for j in range(4096) if j != i), key=lambda j: (-x[i] @ x[j], j))[:10]]
    assert s.rows() == want and s.read < 20 * 4096 / 3


def test_exact_vectors_are_read_by_range(spark, tmp_path):
    """Few of a block's exact bytes are read, each at most once."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 3
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.2
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").coalesce(1)
    (place,) = topk.approximate(topk.whole_numbers(df, "vec_id", "embedding")).collect()

    class Counting:
        def __init__(self, f):
            self.f, self.size, self.ranges = f, 0, set()

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            self.size += n
            return self.f.read(n)

    with open(place.uri.removeprefix("file://"), "rb") as f:
        counting = Counting(f)
        block = topk.Block(counting, place.at, place.n, 16, topk.CELLS)
        cells = counting.size
        whole = np.floor(1024 * x)[block.ids]
        search = topk.Search(block.ids[:5], whole[:5], 10)
        search.block(block.ids, block.codes, block.extremes, block.exact)
        exact = counting.size - cells
        assert place.n == 4000 and exact == 8 * 16 * int(block.exact.have.sum()) < 8 * 16 * 4000 / 3
        assert cells == 8 * 4000 + 16 * 4000 + 16 * 16 * topk.CELLS
        assert np.array_equal(block.exact[np.arange(4000)], whole)
    want = [(int(block.ids[i]), int(block.ids[j]), int(whole[i] @ whole[j])) for i in range(5) for j in sorted((j for j in range(4000) if j != i), key=lambda j: (-whole[i] @ whole[j], block.ids[j]))[:10]]
    assert search.rows() == want


def test_many_shards_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "SHARD_BLOCKS", 2)
    columns, want = _duck("embeddings", topk.TOPK_SQL)
    got = topk.op9_topk(spark, SMALL).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_scores_beyond_floats():
    big = np.array([2.0**28, 1.0, -(2.0**27)])
    assert topk.exact_scores(big, np.stack((big, -big))).tolist() == [2**56 + 1 + 2**54, -(2**56) - 1 - 2**54]
    with pytest.raises(OverflowError):
        topk.exact_scores(np.array([2.0**32]), np.array([[2.0**32]]))


def test_pieces_of_other_scripts_leave_the_rest_to_the_lexicon(spark):
    """Curly quotes, dashes, other scripts, special tokens and odd white space, beside ordinary words."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    odd_texts = [
        "“Don’t,” he said — it’s 5€… or ‘six’", "слово and 日本語 テキスト words ΣΑΣ ΣΑΣ.", "á b ́c é é", "x y　z\x85w v",
        "tab\x1fseparated \x1cwords", "<|endoftext|>mid <|startoftext|> a<|endoftext|>b", "İstanbul ſtraße ǅ ŉ", "🙂🙃 word🙂word", "don't we'LL I'M",
        "​zero​ width﻿", "½ ² ٣ 5", "plain words only", "", "   ",
    ]
    encoder = bpe.Encoder(path)
    seen = []
    encoder._by_library = lambda text, f=encoder._by_library: seen.append(text) or f(text)
    for _ in range(2):
        got = [x.tolist() for x in encoder.ids(odd_texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in odd_texts]
    assert "said" not in " ".join(x for x in seen if "\x1f" not in x).split() and "plain words only" not in seen
    assert "tab\x1fseparated \x1cwords" in seen and "slovo" not in seen and "слово" in seen
    df = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string")
    lexicon = bpe.build_lexicon(df, path)
    rows = bpe.encoded(df, path, lexicon, [F.col("doc_id")]).collect()
    import numpy as np

    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == dict(enumerate(got))
