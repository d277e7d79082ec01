"""Operators: rank-1 per key, surrogate ids, fan-out joins and their counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recount.functions import pg
from recount.operators import joins
from recount.operators.counts import left_join_count, row_count
from recount.operators.joins import left_join_fanout
from recount.operators.rank import first_per_key
from recount.operators.surrogate import surrogate_id
from tests.conftest import optimized_text, plan_text


def test_first_per_key_with_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, None, 3), (1, 5, 1), (2, 4, 2), (2, 4, 1), (None, 1, 9)], "k int, t int, id int"
    )
    got = first_per_key(df, ["k"], [pg.desc("t"), pg.asc("id")]).orderBy("k").collect()
    assert [(r.k, r.t, r.id) for r in got] == [(None, 1, 9), (1, None, 3), (2, 4, 1)]


def test_first_per_key_plans_a_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_text(first_per_key(df, ["k"], [pg.desc("v")]))
    # A partial limit before the exchange: a hot key sends one row per map task.
    above, _, below = plan.partition("Exchange")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_surrogate_id_is_consecutive_in_order(spark):
    df = spark.range(0, 5000, 1, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    out = surrogate_id(df, ["v"], num_ranges=5).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, 5001))
    assert [r.v for r in out] == sorted(r.v for r in out)


def test_left_join_fanout_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (3, "c"), (None, "n")], "k int, lv string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (3, "z"), (None, "q")], "rk int, rv string")
    out = left_join_fanout(left, right, ["k"], ["rk"])
    got = Counter(tuple(r) for r in out.select("k", "lv", "rk", "rv").collect())
    want = Counter(tuple(r) for r in left.join(right, left.k == right.rk, "left").select("k", "lv", "rk", "rv").collect())
    assert got == want and out.columns == ["k", "lv", "rk", "rv"]


def test_join_counts_match_materialized_joins(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "k int")
    lj = left_join_count(left, right, ["k"], ["k"]).first()[0]
    assert lj == left.alias("l").join(right.alias("r"), F.col("l.k") == F.col("r.k"), "left").count() == 9
    assert row_count(left).first()["count"] == 5


def test_fast_counts_equal_extract_counts(spark, cat):
    from recount.plans.suites import all_suites

    for specs in all_suites().values():
        for s in specs:
            src = s.source
            if getattr(src, "count", None) is not None:
                assert src.count(cat).first()[0] == src.rows(cat).count(), s.dest_label


def _hot(spark, n=30000):
    # one key holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_hot_key_fanout_join_and_count(spark):
    left = spark.range(0, 30000, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("lv"))
    left = left.unionByName(spark.range(5).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("lv")))
    right = _hot(spark).select(F.col("k").alias("rk"), "v")
    plain = left.join(right, left.k == right.rk, "left")
    split = left_join_fanout(left, right, ["k"], ["rk"])
    assert Counter(tuple(r) for r in split.collect()) == Counter(tuple(r) for r in plain.collect())
    assert left_join_count(left, right, ["k"], ["rk"]).first()[0] == plain.count()


def test_hot_key_is_split_on_the_right_side(spark):
    """Adaptive execution reads the hot partition of the fanning side in several tasks."""
    left = spark.range(40000).select(F.col("id").alias("k"))
    right = _hot(spark, 300_000).select(F.col("k").alias("rk"), "v")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = left_join_fanout(left, right, ["k"], ["rk"])
        rows = df.count(), df.filter("rk IS NULL").count()
        assert rows == (left.join(right, left.k == right.rk, "left").count(), left.join(right, left.k == right.rk, "left_anti").count())
        joined = left.join(right, left.k == right.rk, "inner")
        joined.collect()
        assert "skew=true" in plan_text(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("both_hot", [False, True])
def test_fanout_join_of_rows_hot_on_both_sides(spark, monkeypatch, both_hot):
    monkeypatch.setattr(joins, "BLOCK", 4)
    left = spark.createDataFrame(
        [(i % 2, i) for i in range(30)] + [(5, 1)] * 9 + [(6, 0), (7, None), (None, 1), (None, 2)], "k int, lv int")
    right = spark.createDataFrame(
        [(i % 2, f"r{i}") for i in range(21)] + [(5, "same")] * 11 + [(7, None), (8, "x"), (None, "q")], "rk long, rv string")
    got = left_join_fanout(left, right, ["k"], ["rk"], both_hot)
    want = left.join(right, left.k == right.rk, "left")
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())
    assert got.columns == ["k", "lv", "rk", "rv"] and got.dtypes == want.dtypes


def test_many_warm_keys_and_a_hot_one(spark):
    right = spark.range(60_000).select((F.col("id") % 20_000).alias("rk"), F.col("id").alias("v")).unionByName(
        spark.range(30_000).select(F.lit(7).cast("bigint").alias("rk"), F.col("id").alias("v")))
    left = spark.range(25_000).select(F.col("id").alias("k"))
    got = left_join_fanout(left, right, ["k"], ["rk"]).groupBy().agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.count("rk").alias("m")).first()
    want = left.join(right, left.k == right.rk, "left").groupBy().agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.count("rk").alias("m")).first()
    assert got == want


def test_hot_key_first_per_key(spark):
    got = first_per_key(_hot(spark), ["k"], [pg.desc("v")]).filter("k = 7").collect()
    assert [r.v for r in got] == [29997]


def test_surrogate_ids_repeat_across_actions(spark):
    df = spark.range(0, 3000, 1, numPartitions=6).select(((F.col("id") * 37) % 1000).alias("v"), F.col("id").alias("w"))
    ids = surrogate_id(df, ["v", "w"], num_ranges=4)
    first = sorted((r.id, r.v, r.w) for r in ids.collect())
    second = sorted((r.id, r.v, r.w) for r in ids.collect())
    assert first == second and [r[0] for r in first] == list(range(1, 3001))


def test_surrogate_id_edge_sizes(spark):
    empty = spark.range(0).select(F.col("id").alias("v"))
    assert surrogate_id(empty, ["v"]).count() == 0
    few = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("b", None)], "v string, w int")
    got = sorted(((r.id, r.v, r.w) for r in surrogate_id(few, ["v", "w"], num_ranges=16).collect()), key=lambda r: r[0])
    assert got == [(1, "a", 3), (2, "b", 1), (3, "b", None), (4, None, 2)]  # nulls last


def test_surrogate_id_plan_does_not_grow_with_its_ranges(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"))
    few, many = surrogate_id(df, ["v"], num_ranges=4), surrogate_id(df, ["v"], num_ranges=2000)
    plans = [optimized_text(x) for x in (few, many)]
    assert abs(len(plans[0]) - len(plans[1])) < 50 and "CASE" not in plans[1]
    assert [r.id for r in many.orderBy("v").collect()] == list(range(1, 20_001))


def test_surrogate_id_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long")
    ids = surrogate_id(df, ["id"], name="n", num_ranges=4)
    assert ids.count() == 1000 and ids.agg(F.max("n")).first()[0] == 1000 and seen.value == 1000


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from recount.sources.shared import shared_base

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_base(cluster)
    cluster.conf["spark.checkpoint.dir"] = "hdfs://name/shared/"
    assert shared_base(cluster) == "hdfs://name/shared"


def test_fanout_join_exchanges_each_side_once(spark):
    left = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("lv"))
    right = _hot(spark, 30_000).select(F.col("k").alias("rk"), "v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = left_join_fanout(left, right, ["k"], ["rk"])
        df.collect()
        final = plan_text(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    fresh = [x for x in final.splitlines() if "Exchange hashpartitioning" in x and "Reused" not in x]
    # The left side once (its second use is a reused exchange), the right side once, and its distinct keys.
    assert len(fresh) == 3 and final.count("ReusedExchange") == 1, final


def test_names_by_locale_equals_two_joins(spark):
    from recount.plans.extracts.user import names_by_locale

    rows = [(1, "en", "One"), (1, "ar", "Wahid"), (2, "ar", "Ithnan"), (3, "en", None), (3, "ar", "Thalatha"), (3, "ar", "T3"),
            (4, "en", None), (5, "en", "Five"), (5, "en", "Cinq"), (5, "en", None), (5, "ar", "Khamsa"), (6, "fr", "Six"),
            (7, "ar", None), (8, "en", "Same"), (8, "ar", "Same"), (9, "en", None), (9, "ar", None), (9, "en", "Nine"), (None, "en", "x"),
            (10, "en", ""), (10, "en", None)]
    t = spark.createDataFrame(rows, "k int, locale string, name string")
    base = spark.range(1, 12).select(F.col("id").cast("int").alias("id"))
    en, ar = t.filter("locale = 'en'").alias("en"), t.filter("locale = 'ar'").alias("ar")
    both = base.join(en, F.col("en.k") == F.col("id"), "left").join(ar, F.col("ar.k") == F.col("id"), "left")
    for default in (None, ""):
        want = both.select("id", F.coalesce(F.col("en.name"), F.col("ar.name"), F.lit(default)).alias("n")).distinct()
        names = names_by_locale(t, "k", default)
        got = base.join(names, F.col("key") == F.col("id"), "left").select("id", F.coalesce("name", F.lit(default)).alias("n"))
        assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())
