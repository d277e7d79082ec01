"""Alignment against a plain restatement over whole texts, with cuts anywhere."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recount.llm import alignment as al
from tests.llm.conftest import SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole_texts():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    t = al.Tokenizers(A, B)

    def tokens(text):
        """Whole-text tokens with their ends, or None."""
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = [[t.a_bytes[i] for i in ids_a], [t.b_bytes[i] for i in ids_b]]
        if not b"".join(raw[0]) == (" " + text).encode() == b"".join(raw[1]):
            return None
        ends = [[sum(map(len, r[: i + 1])) for i in range(len(r))] if len(r) < 2000 else _running(r) for r in raw]
        return ids_a, ends[0], ids_b, ends[1]

    return tokens


def _running(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def _aligned(tokens):
    """(groups, links) by walking over both."""
    ids_a, ends_a, ids_b, ends_b = tokens
    groups, links, i, j = [], [], 0, 0
    for e in sorted(set(ends_a) & set(ends_b)):
        ga, gb = [], []
        while i < len(ids_a) and ends_a[i] <= e:
            ga.append(ids_a[i])
            i += 1
        while j < len(ids_b) and ends_b[j] <= e:
            gb.append(ids_b[j])
            j += 1
        groups.append(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}")
        links.append((ga[-1], gb[-1]))
    return ";".join(groups), links


def _brute(texts, tokens):
    found = [tokens(t) for t in texts]
    done = [_aligned(x) if x else None for x in found]
    count = Counter(p for d in done if d for p in d[1])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for x, d in zip(found, done):
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = d
        sha = hashlib.sha256(groups.encode()).hexdigest()
        out.append((len(x[0]), len(x[2]), groups.count(";") + 1, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha))
    return out


def _rows(df, key):
    sha = F.coalesce(F.sha2(F.col("groups").cast("binary"), 256), F.lit(""))
    return [tuple(r) for r in df.select(*key, *al.NUMBERS, sha).collect()]


ODD = [None, "", " ", "\n", "a", "  two  spaces ", "tab\there\nline  end ", "é ü ñ", "日本語 テキスト", "x▁y", "▁", "emoji 🙂🙃 zwj 👩‍👩‍👧", "<s> </s> <|endoftext|> <unk> <0x41>",
       "don't we'll it's", "12345 6,789.10", "a" * 300, " nbsp  　wide", "\x00nul\x1f", "trailing ", "́ combining ́x", "mixed\r\n\r\n  lines\n"]


def test_monoid_laws_and_any_cuts(whole_texts):
    rng = random.Random(3)
    for text in [t for t in ODD if t] + ["The quick brown fox unquestionably jumps over " * 3]:
        tokens = whole_texts(text)
        if tokens is None:
            continue
        want = _aligned(tokens)
        size = tokens[1][-1]
        for _ in range(6):
            cuts = sorted({0, size, *(rng.randrange(size + 1) for _ in range(5))})
            parts = []
            for lo, hi in zip(cuts, cuts[1:]):
                inside = []
                for ids, ends in (tokens[:2], tokens[2:]):
                    mine = [(i, e) for i, e in zip(ids, ends) if lo < e <= hi]
                    inside += [[i for i, _ in mine], [e for _, e in mine]]
                parts.append(al.fragment(*inside))
            pieces = [p for p, _ in parts]
            left = al.EMPTY
            for p in pieces:
                left = al.compose(left, p)
            right = al.EMPTY
            for p in reversed(pieces):
                right = al.compose(p, right)
            assert left == right and al.groups_of(left) == want[0] and [x for _, found in parts for x in found] == want[1]
            k = len(pieces) // 2
            half = [al.EMPTY, al.EMPTY]
            for i, p in enumerate(pieces):
                half[i >= k] = al.compose(half[i >= k], p)
            assert al.compose(*half) == left


@pytest.mark.parametrize("chunk,table", [(1 << 15, 1 << 17), (7, 40), (64, 1 << 17)])
def test_equals_whole_text_tokens(spark, monkeypatch, whole_texts, chunk, table):
    """Chunks of a few characters are cut within words and tokens; small tables are emptied again and again."""
    monkeypatch.setattr(al, "CHUNK", chunk)
    monkeypatch.setattr(al, "TABLE_SEGMENTS", table)
    monkeypatch.setattr(al, "BLOCK", 16 if chunk < 100 else 1 << 12)
    monkeypatch.setattr(al, "FAN", 3 if chunk < 100 else 16)
    monkeypatch.setattr(al, "ROWS", 5 if chunk < 100 else 64)
    docs = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").select("text").collect()]
    texts = [*ODD, "one", "one", *([x[:400] for x in docs[:60]] if chunk < 100 else [*docs, "many words of a long text " * 9000, "nospace" * 9000])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(_rows(al.align(df, A, B, [F.col("doc_id")]), ["doc_id"]))
    assert [g[1:] for g in got] == _brute(texts, whole_texts)


def test_long_texts_without_tokens_count_no_link(spark, monkeypatch, whole_texts):
    """One bad chunk among many: the links of the others must not count."""
    monkeypatch.setattr(al, "CHUNK", 32)
    words = "some plain words that stand in every text of this table and nowhere else " * 4
    texts = [words, words + "x▁y " + words, words + "double  space " + words, words[:90], words]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(_rows(al.align(df, A, B, [F.col("doc_id")]), ["doc_id"]))
    assert [g[1:] for g in got] == _brute(texts, whole_texts)
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "")


def test_cut_covers_every_byte():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice("ab é \n  ") for _ in range(rng.randrange(1, 80)))
        parts = al.cut(text, rng.choice([3, 5, 11]))
        raw = (" " + text).encode()
        seen = b"".join(p[2].encode()[p[3] : p[4]] for p in parts)
        assert seen == raw and [p[0] for p in parts] == list(range(parts[0][1]))


def test_odd_tables(spark, odd, none, whole_texts):
    out = al.align(odd, A, B, [F.col("doc_id"), F.col("text"), F.col("h")])
    rows = _rows(out, ["doc_id", "text", "h"])
    texts = [r[1] for r in rows]
    assert len(rows) == odd.count() and [r[3:] for r in rows] == _brute(texts, whole_texts)
    assert al.align(none, A, B, [F.col("doc_id")]).count() == 0
    assert out.columns == ["doc_id", "text", "h", *al.NUMBERS, "groups"]
