"""Conversation tries against SQL and brute force, in one piece and in many."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest

from recount.llm import conversation_trie as ct
from recount.llm.radix import RadixTree, _Indexed, _Listed, _Slots, shared
from tests.llm.conftest import SMALL


def test_radix_tree():
    rng = random.Random(5)
    keys = {bytes(rng.randrange(3) for _ in range(rng.randrange(9))) for _ in range(400)} | {bytes([b, 7]) for b in range(256)}
    tree = RadixTree()
    order = list(keys)
    rng.shuffle(order)
    for k in order:
        tree.insert(k, k.hex())
    assert all(tree.get(k) == k.hex() for k in keys) and tree.get(b"\x00\x01\x02\x00\x01\x02\x00\x01\x02\x05") is None
    assert isinstance(tree.root.branches, _Slots)
    seen, waiting = [], [(tree.root, b"")]
    while waiting:
        node, path = waiting.pop()
        path += node.prefix
        if node.value is not None:
            seen.append(path)
        waiting += [(n, path + bytes([b])) for b, n in reversed(list(node.items()))]
    assert seen == sorted(keys)
    for n, kind in ((4, _Listed), (5, _Listed), (16, _Listed), (17, _Indexed), (48, _Indexed), (49, _Slots)):
        small = RadixTree()
        for b in range(n):
            small.insert(bytes([b]), b)
        assert type(small.root.branches) is kind and [b for b, _ in small.root.items()] == list(range(n))
    assert shared(b"", b"a") == 0 and shared(b"abcd", b"abce") == 3 and shared(b"ab", b"abc") == 2


def _brute(rows):
    """rows: (conv_id, turn, role, text)"""
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    ws = " \t\n\x0b\x0c\r"
    n_words = lambda s: len("".join(" " if ch in ws else ch for ch in s).split(" ")) - "".join(" " if ch in ws else ch for ch in s).split(" ").count("")
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = ((len(members[p]) - 1) * n_words(p[-1][1]) if p else 0) + sum(saved[k] for k in kids.get(p, []))
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(COLS).collect()), key=str)


def _made(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-5, 40), *range(200, 200 + n)]:
        turns = [rng.choice(["a b", "c", "", None, "d  e f"]) for _ in range(rng.randrange(1, 7))] if c % 3 else ["a b", "c", "d  e f"]
        rows += [(c, None if rng.random() < 0.05 else i, rng.choice(["user", None]) if c % 3 else "user", t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "no conversation"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "user", "eit")]
    rows += [(1000003, i, "user", f"turn {i % 3}") for i in range(400)]
    return rows


@pytest.mark.parametrize("piece,chunk", [(32 << 20, 1 << 16), (200, 3), (61, 1)])
def test_equals_brute_force(spark, monkeypatch, piece, chunk):
    """Pieces of a few keys: nearly every node is on a path, and many lie in several pieces."""
    monkeypatch.setattr(ct, "PIECE", piece)
    monkeypatch.setattr(ct, "CHUNK", chunk)
    rows = _made(piece)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _rows(ct.conversation_trie(df)) == _brute(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{SMALL}/conversations.parquet'")
    rel = con.sql(ct.TRIE_SQL)
    assert rel.columns == COLS
    got = ct.op12_conversation_trie(spark, SMALL)
    assert _rows(got) == sorted(map(tuple, rel.fetchall()), key=str) and len(_rows(got)) > 50


def test_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, key string, digest int, n int, kd string, ends string"
    assert ct.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    nothing = spark.createDataFrame([(None, 1, "a", "b", "k", 1, 2, "x", "y")], schema)
    assert ct.conversation_trie(nothing).count() == 0
    long_ = "word " * 200_000
    rows = [(3, None, None, None), (3, 1, "user", long_), (4, 1, "user", long_), (4, 1, "user", long_), (23, 0, "", "")]
    df = spark.createDataFrame([(*r, "k", 1, 2, "x", "y") for r in rows], schema)
    assert _rows(ct.conversation_trie(df)) == _brute(rows)
