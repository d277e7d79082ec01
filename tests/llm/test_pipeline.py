"""The stages one after the other, each against its operator's brute force, on odd input too."""

from collections import Counter

import corpus_pipeline as cp
from recount.llm import quality, simhash
from recount.llm.common import written
from recount.llm.components import connected_components
from tests.conftest import plan_text
from tests.llm.conftest import SMALL
from tests.llm.test_native import _deduped
from tests.llm.test_near import _classes, _cut, _fingerprint


def _by_hand(spark, docs):
    """What the first four stages keep: (id, text) pairs."""
    kept = {(r.doc_id, r.text) for r in quality.quality_cascade(docs, keep=["doc_id", "text"]).filter("kept").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect() if tuple(r) in kept]
    rows = [(i, t) for i, t, _ in _deduped(rows)]
    fps = [_fingerprint(t) for _, t in rows]
    u = sorted(set(fps))
    of = _classes(u, [(a, b) for k, a in enumerate(u) for b in u[k + 1 :] if (a ^ b).bit_count() <= 3])
    least = {}
    for (i, _), f in zip(rows, fps):
        least[of[f]] = min(i, least.get(of[f], i))
    rows = [(i, t) for (i, t), f in zip(rows, fps) if least[of[f]] == i]
    cut = _cut([(t or "").encode() for _, t in rows], 400)
    return Counter((i, k.decode("utf-8", "ignore")) for (i, _), (_, _, _, k) in zip(rows, cut))


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "suffix_array_dedup", "best_fit_packing"]
    docs = first = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.dtypes == first.dtypes
    assert Counter(tuple(r) for r in docs.select("doc_id", "text").collect()) == _by_hand(spark, first)
    changed = docs.join(first.selectExpr("doc_id", "text AS was", "n_chars AS n"), "doc_id")
    assert changed.filter("n_chars <> CASE WHEN text = was THEN n ELSE length(text) END").count() == 0
    packed = cp.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    assert sorted(cp.run(spark, SMALL).collect()) == sorted(packed.collect())


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    for table in (odd, none):
        docs = table.selectExpr("*", "'en' AS lang", "length(text) AS n_chars")
        for name, stage in cp.STAGES[:-1]:
            docs = written(stage(spark, docs, SMALL), name)
            assert docs.columns == [*table.columns, "lang", "n_chars"]
        cp.STAGES[-1][1](spark, docs, SMALL).collect()


def test_fingerprint_stage_broadcasts_no_index(spark, monkeypatch):
    docs, plans = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    monkeypatch.setattr(simhash, "connected_components", lambda links: plans.append(plan_text(links)) or connected_components(links))
    cp.simhash_stage(spark, docs, SMALL)
    # The lists are exploded from fingerprints of a few MB: the fingerprints' size says nothing of theirs.
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
