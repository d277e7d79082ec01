"""Catalog behaviour that does not need a live database."""

import pytest
from pyspark.sql import functions as F

from recount.plans.report import suite_report
from recount.plans.suites import order_suite
from recount.sources.catalog import FrameCatalog, JdbcCatalog, JdbcPartitioning, ParquetCatalog


class _Reader:
    def __init__(self, log):
        self.log = log

    def option(self, k, v):
        self.log[k] = v
        return self

    def load(self):
        return self.log


class _FakeJdbc(JdbcCatalog):
    def __init__(self, spark, partitioning):
        super().__init__(spark, "jdbc:postgresql://h/db", {"user": "u"}, partitioning)
        self.queries = []

    def _reader(self, name):
        return _Reader({"dbtable": name})

    def _query(self, sql):
        self.queries.append(sql)
        return self.spark.createDataFrame([(3, 1_000_002)], "lo bigint, hi bigint")


def test_jdbc_partition_bounds_from_the_table(spark):
    cat = _FakeJdbc(spark, {"spree_orders": JdbcPartitioning("id", num_partitions=64)})
    opts = cat._load("spree_orders")
    assert cat.queries == ["SELECT min(id) AS lo, max(id) AS hi FROM spree_orders"]
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == (
        "id", "3", "1000003", "64")
    assert cat.fuse_scans is False


def test_counts_are_sent_to_the_database(spark):
    cat = _FakeJdbc(spark, {})
    cat.count("spree_orders")
    cat.count("spree_orders", "state != 'cart'")
    assert cat.queries == ["SELECT count(*) AS n FROM spree_orders",
                           "SELECT count(*) AS n FROM spree_orders WHERE state != 'cart'"]
    with pytest.raises(ValueError, match="SQL text"):
        cat.count("spree_orders", F.col("state") != "cart")


def test_suite_scans_send_their_condition(spark):
    sent = []

    class Counting(_FakeJdbc):
        def _query(self, sql):
            sent.append(sql)
            return self.spark.createDataFrame([(7,)], "n bigint")

    cat = Counting(spark, {})
    specs = [s for s in order_suite() if s.dest_label == "order"]
    row = suite_report(specs, cat, cat).first()
    assert (row["Source Count"], row["Destination Count"]) == (7, 7)
    assert sent == ["SELECT count(*) AS n FROM spree_orders WHERE state != 'cart'", "SELECT count(*) AS n FROM public.order"]


def test_unpartitioned_reads_are_a_choice(spark):
    cat = _FakeJdbc(spark, {})
    cat.unpartitioned = "error"
    with pytest.raises(ValueError, match="one task"):
        cat._load("spree_orders")


def test_jdbc_given_bounds_skip_the_query(spark):
    cat = _FakeJdbc(spark, {"t": JdbcPartitioning("id", 8, lower=0, upper=99)})
    assert cat._load("t")["upperBound"] == "100" and cat.queries == []


def test_parquet_and_frame_catalogs(spark):
    cat = ParquetCatalog(spark, "/root/testdata/sf0.001")
    assert cat["region"].count() == 5 and cat.table("region") is cat["region"]  # cached
    frames = FrameCatalog(spark, {"a": spark.range(3), "b": lambda: spark.range(4)})
    assert frames["a"].count() == 3 and frames["b"].count() == 4
    fn = lambda c: c["a"].filter("id > 0")
    assert frames.derive(fn) is frames.derive(fn)  # one frame per derivation


def test_quantile_ranges_of_a_skewed_text_key(spark):
    """Every row meets one condition, and a value that fills several ranges is dealt over as many parts."""
    from recount.sources.catalog import key_ranges, quantile_query

    p = JdbcPartitioning("code", num_partitions=8, by="quantiles", spread="n")
    sql = quantile_query("spree_codes", p)
    assert "percentile_disc(ARRAY[0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) WITHIN GROUP (ORDER BY code)" in sql
    values = sorted(["hot"] * 500 + [f"k{i:03d}" for i in range(300)] + ["it's"] * 3 + [""] * 2)
    cut = [values[len(values) * i // 8] for i in range(1, 8)]
    borders = [(b, cut.count(b)) for b in dict.fromkeys(cut)]
    assert max(n for _, n in borders) > 3
    rows = [(v, i - 400) for i, v in enumerate(values)] + [(None, 7), (None, 8)]
    spark.createDataFrame(rows, "code string, n int").createOrReplaceTempView("codes")
    for spread in ("n", None):
        parts = key_ranges("code", borders, spread)
        sizes = [spark.sql(f"SELECT count(*) FROM codes WHERE {c}").first()[0] for c in parts]
        assert sum(sizes) == len(rows)
        met = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in parts)
        assert spark.sql(f"SELECT count(*) FROM codes WHERE {met} = 1").first()[0] == len(rows)
        assert max(sizes) < 220 if spread else max(sizes) >= 500
    assert key_ranges("code", []) == ["1 = 1"]
    spark.catalog.dropTempView("codes")


def test_quantile_partitioning_reads_a_task_per_range(spark):
    class Quantiles(_FakeJdbc):
        def _query(self, sql):
            self.queries.append(sql)
            return self.spark.createDataFrame([("b", 1), ("d", 1)], "border string, times bigint")

        def _load_parts(self, name, conditions):
            return name, conditions

    cat = Quantiles(spark, {"t": JdbcPartitioning("code", num_partitions=3, by="quantiles")})
    assert cat._load("t") == ("t", ["(code < 'b' OR code IS NULL)", "code >= 'b' AND code < 'd'", "code >= 'd'"])
    assert len(cat.queries) == 1
