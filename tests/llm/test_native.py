"""Quality rules and line dedup against SQL, and on odd input."""

import hashlib
import re

import duckdb
import pytest

from recount.llm import line_dedup, quality
from tests.llm.conftest import SMALL


def _duck(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SMALL}/documents.parquet'")
    rel = con.sql(sql)
    return rel.columns, sorted(map(tuple, rel.fetchall()))


@pytest.mark.parametrize(
    "query,sql",
    [(quality.op8_quality, quality.QUALITY_SQL), (line_dedup.op7_line_dedup, line_dedup.LINE_DEDUP_SQL)],
)
def test_query_equals_sql(spark, query, sql):
    df = query(spark, SMALL)
    columns, want = _duck(sql)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _stats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    covered = set()
    starts = {}
    for i in range(len(w) - 7):
        starts.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in starts.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(8)}
    full = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(covered)


def test_figures_on_odd_texts(odd, none):
    got = quality.quality_cascade(odd, keep=["text"]).collect()
    assert len(got) == odd.count()
    for r in got:
        want = _stats(r["text"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    kept = quality.kept_rows(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)
    assert quality.quality_cascade(none).count() == 0 and quality.kept_rows(none).count() == 0


def test_order_of_rules_decides_nothing(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a = quality.quality_cascade(docs).select("doc_id", "kept").collect()
    b = quality.quality_cascade(docs, rules=quality.RULES[::-1], sample_rows=1).select("doc_id", "kept").collect()
    assert sorted(a) == sorted(b)
    stats = quality.text_stats(docs)
    assert {r.name for r in quality.order_rules(stats)} == {r.name for r in quality.RULES}


def test_rules_are_ordered_by_rejection_per_cost(spark):
    """Cost and rejections are measured in tasks; no text is shuffled or brought to the driver for it."""
    rows = [(i, ("#### " if i % 2 else "") + "some ordinary words " * 40) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    dear = quality.Rule("dear", "length(regexp_replace(text, '([a-z]+) ([a-z]+)', '$2 $1')) < 0 OR n_symbols > 0")
    never, cheap = quality.Rule("never", "n_words < 0"), quality.Rule("cheap", "n_symbols > 0")
    stats = quality.text_stats(docs, repeats=False)
    assert [r.name for r in quality.order_rules(stats, (never, dear, cheap))] == ["cheap", "dear", "never"]
    assert quality.order_rules(stats.filter("false"), (never, dear)) == [never, dear] and quality.order_rules(stats, ()) == []


def test_repeated_words_as_one_expression(spark, odd):
    from pyspark.sql import functions as F

    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id").cast("long"), "text"))
    figures = quality.text_stats(docs, keep=["text"], repeats=False)
    for r in figures.select(F.col("__k0").alias("t"), quality._repeat_words(F.col("__w")).alias("n")).collect():
        assert r.n == _stats(r.t)[4]


def _deduped(rows, least=20, docs=3):
    """Brute force: (id, text) rows, each a document."""
    ws = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(ws).translate(low)
    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least:
                holders.setdefault(k, []).append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for x in lines:
            h = holders.get(key(x), [])
            ids = [z for z in h if z is not None]
            gone = len(h) >= docs and ids and (i is None or i < max(ids))
            if not gone:
                stay.append(x)
        out.append((i, "\n".join(stay), len(lines) - len(stay)))
    return out


def test_lines_on_odd_texts(odd, none):
    got = line_dedup.apply_bitmaps(odd, line_dedup.line_bitmaps(odd))
    assert got.columns == [*odd.columns, "__kept_text", "__n_dropped"]
    key = lambda r: (r[0] is None, r[0], r[1], r[2])
    want = sorted(_deduped([tuple(r) for r in odd.select("doc_id", "text").collect()]), key=key)
    assert sorted((tuple(r) for r in got.select("doc_id", "__kept_text", "__n_dropped").collect()), key=key) == want
    assert sum(x[2] for x in want) >= 4
    assert line_dedup.apply_bitmaps(none, line_dedup.line_bitmaps(none)).count() == 0


def test_bitmap_words(spark):
    common = "a line that every document has in it"
    text = "\n".join(common if i in (0, 63, 64, 200) else f"{i}" for i in range(201))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    rows = {r["__id"]: r for r in line_dedup.line_bitmaps(docs).collect()}
    assert set(rows) == {0, 1}
    assert [(w.word, w.bits) for w in rows[0].drop_words] == [(0, 1 - (1 << 63)), (1, 1), (3, 1 << 8)] and rows[0].n_dropped == 4
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).filter("doc_id = 0").first()["__kept_text"]
    assert hashlib.sha256(kept.encode()).digest() == hashlib.sha256("\n".join(x for x in text.split("\n") if x != common).encode()).digest()


def test_folding_keeps_texts_apart(spark):
    words = ["À", "à", "A", "a", "é", "É", "ã", "Ã", "ß", "×", "÷", "日本", "ｱ", "İ", "i", "ſ", "s", "Ω", "𝐀"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    from pyspark.sql import functions as F

    got = {r.w: r.k for r in df.select("w", line_dedup._folded(F.col("w")).alias("k")).collect()}
    assert got["A"] == got["a"] and len(set(got.values())) == len(words) - 1
