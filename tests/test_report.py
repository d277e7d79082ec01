"""Report rules (R3, R4), suite runs (R2, R5, R6, R10), error policies (R7), sinks."""

import pytest
from pyspark.sql import functions as F

from recount.plans.report import run_suite, show_report, suite_report, with_verdict, write_report
from recount.plans.spec import Const, Extract, ReconSpec, Scan
from recount.sources.catalog import FrameCatalog


@pytest.mark.parametrize(
    "src,dst,result,comment",
    [
        (10, 10, "count matches", "All records are migrated"),
        (12, 10, "count mismatch", "Number of records not migrated : 2"),
        (10, 12, "count mismatch", "Destination count is greater than Source Count"),
        (0, 0, "count matches", "All records are migrated"),
        (0, 7, "count mismatch", "Destination count is greater than Source Count"),
        (7, 0, "count mismatch", "Number of records not migrated : 7"),
    ],
)
def test_verdict_and_comment(spark, src, dst, result, comment):
    df = spark.createDataFrame([(src, dst)], "`Source Count` bigint, `Destination Count` bigint")
    row = with_verdict(df).first()
    assert row["Result"] == result
    assert row["Comments"] == comment


def _catalog(spark):
    t = spark.range(10).withColumn("even", F.col("id") % 2 == 0)
    return FrameCatalog(spark, {"t": t, "t_half": t.filter("even"), "empty": spark.range(0)})


def _specs():
    return [
        ReconSpec("s", 2, "t", "t_half", Scan("t"), Scan("t_half")),
        ReconSpec("s", 1, "t", "t", Scan("t"), Scan("t")),
        ReconSpec("s", 3, "t_even", "t", Scan("t", "even"), Scan("t")),
        ReconSpec("s", 4, "NA", "t_half", Const(5), Scan("t_half")),
        ReconSpec("s", 5, "joined", "t", Extract(lambda c: c["t"].join(c["t_half"], "id")), Scan("t")),
    ]


def test_suite_report_rows_in_spec_order(spark):
    cat = _catalog(spark)
    rows = suite_report(_specs(), cat, cat).orderBy("ord").collect()
    got = [(r["ord"], r["Source Table"], r["Destination Table"], r["Source Count"], r["Destination Count"], r["Result"],
            r["Comments"]) for r in rows]
    assert got == [
        (1, "t", "t", 10, 10, "count matches", "All records are migrated"),
        (2, "t", "t_half", 10, 5, "count mismatch", "Number of records not migrated : 5"),
        (3, "t_even", "t", 5, 10, "count mismatch", "Destination count is greater than Source Count"),
        (4, "NA", "t_half", 5, 5, "count matches", "All records are migrated"),
        (5, "joined", "t", 5, 10, "count mismatch", "Destination count is greater than Source Count"),
    ]


def test_scans_of_one_table_are_fused(spark):
    from tests.conftest import optimized_text

    cat = _catalog(spark)
    specs = [
        ReconSpec("s", 1, "t", "t", Scan("t"), Scan("t")),
        ReconSpec("s", 2, "t_even", "t", Scan("t", "even"), Scan("t", "NOT even")),
    ]
    plan = optimized_text(suite_report(specs, cat, cat))
    # Four counts over table t, one Range (scan) node.
    assert plan.count("Range (0, 10") == 1


def test_missing_table_stop_keeps_prefix(spark):
    cat = _catalog(spark)
    specs = _specs()[:2] + [ReconSpec("s", 3, "nope", "t", Scan("missing"), Scan("t"))] + _specs()[2:]
    specs[3] = ReconSpec("s", 4, "t_even", "t", Scan("t", "even"), Scan("t"))
    rows = {r["ord"]: r for r in suite_report(specs, cat, cat, on_error="stop").collect()}
    assert sorted(rows) == [1, 2, 3]  # the failing spec is named, the one after it is not reached
    assert rows[3]["Source Count"] is None and rows[3]["Result"] == "count mismatch" and rows[3]["Comments"]


@pytest.mark.parametrize("at", [1, 2, 3])
@pytest.mark.parametrize("policy", ["stop", "isolate", "raise"])
def test_missing_table_in_any_place(spark, at, policy):
    cat = _catalog(spark)
    specs = [ReconSpec("s", i, "t", "t", Scan("missing" if i == at else "t"), Scan("t")) for i in (1, 2, 3)]
    if policy == "raise":
        with pytest.raises(Exception, match="missing"):
            run_suite(specs, cat, cat, on_error=policy)
        return
    rows = {r["ord"]: r for r in run_suite(specs, cat, cat, on_error=policy).collect()}
    assert sorted(rows) == list(range(1, (at if policy == "stop" else 3) + 1))
    assert "missing" in rows[at]["Comments"]
    assert all(r["Result"] == ("count mismatch" if i == at else "count matches") for i, r in rows.items())


def test_missing_table_isolate_reports_error(spark):
    cat = _catalog(spark)
    specs = [ReconSpec("s", 1, "t", "t", Scan("t"), Scan("t")),
             ReconSpec("s", 2, "nope", "t", Scan("missing"), Scan("t")),
             ReconSpec("s", 3, "t", "t_half", Scan("t"), Scan("t_half"))]
    rows = {r["ord"]: r for r in suite_report(specs, cat, cat, on_error="isolate").collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2]["Source Count"] is None and rows[2]["Error"]
    assert rows[2]["Result"] == "count mismatch"
    assert rows[3]["Comments"] == "Number of records not migrated : 5"


def test_runtime_failure_isolated_per_spec(spark):
    base = spark.createDataFrame([("1",), ("x",)], "v string")
    cat = FrameCatalog(spark, {"ok": base, "bad": base.select(F.col("v").cast("int").alias("v"))})
    specs = [ReconSpec("s", 1, "ok", "ok", Scan("ok"), Scan("ok")),
             ReconSpec("s", 2, "bad", "ok", Extract(lambda c: c["bad"].filter("v > 0")), Scan("ok")),
             ReconSpec("s", 3, "ok", "ok", Scan("ok"), Scan("ok"))]
    iso = {r["ord"]: r for r in run_suite(specs, cat, cat, on_error="isolate").collect()}
    assert iso[1]["Result"] == "count matches" and iso[3]["Result"] == "count matches"
    assert iso[2]["Error"] and iso[2]["Source Count"] is None
    stop = run_suite(specs, cat, cat, on_error="stop").collect()
    assert [r["ord"] for r in stop] == [1, 2] and stop[1]["Comments"] == iso[2]["Error"]
    assert len(iso[2]["Error"]) > 500 or "\n" in iso[2]["Error"] or "CAST_INVALID_INPUT" in iso[2]["Error"]  # whole


def test_write_report_csv_roundtrip(spark, tmp_path):
    cat = _catalog(spark)
    out = str(tmp_path / "report")
    write_report(suite_report(_specs(), cat, cat), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["Source Table", "Destination Table", "Source Count", "Destination Count", "Result", "Comments"]
    rows = back.collect()
    assert len(rows) == 5
    assert rows[1]["Comments"] == "Number of records not migrated : 5"


def test_show_report(spark, capsys):
    cat = _catalog(spark)
    show_report(suite_report(_specs(), cat, cat))
    out = capsys.readouterr().out
    assert "Number of records not migrated : 5" in out and "count matches" in out


def test_unfused_catalog_counts_each_scan_alone(spark):
    from tests.conftest import optimized_text

    class PushDownCatalog(FrameCatalog):
        fuse_scans = False

    t = spark.range(10).withColumn("even", F.col("id") % 2 == 0)
    cat = PushDownCatalog(spark, {"t": t})
    specs = [ReconSpec("s", 1, "t", "t", Scan("t"), Scan("t", "even"))]
    rep = suite_report(specs, cat, cat)
    assert [(r["Source Count"], r["Destination Count"]) for r in rep.collect()] == [(10, 5)]
    assert optimized_text(rep).count("Range (0, 10") == 2  # one count per side, each pushable


def test_failed_suite_reruns_several_specs_at_a_time(spark):
    """Under ``stop`` a failing spec cancels the running jobs of later ones; the rows before it stay."""
    import time

    from pyspark.sql import functions as F

    from recount.plans.report import run_suite
    from recount.plans.spec import Const, Extract, ReconSpec
    from recount.sources.catalog import FrameCatalog

    def slow(seconds):
        def work(batches):
            time.sleep(seconds)
            yield from batches

        return Extract(lambda cat: cat.spark.range(0, 3, 1, 1).mapInPandas(work, "id long"))

    bad = Extract(lambda cat: cat.spark.range(0, 3, 1, 1).filter(F.when(F.col("id") == 1, F.raise_error(F.lit("bad value"))).isNull()))
    spec = lambda ord, side: ReconSpec("s", ord, f"t{ord}", f"t{ord}", side, Const(3))
    cat = FrameCatalog(spark, {})
    specs = [spec(1, slow(2)), spec(2, slow(2)), spec(3, bad), spec(4, slow(60)), spec(5, slow(60))]
    began = time.perf_counter()
    rows = run_suite(specs[:3], cat, cat, "isolate").orderBy("ord").collect()
    assert [(r["ord"], r["Source Count"]) for r in rows] == [(1, 3), (2, 3), (3, None)] and "bad value" in rows[2]["Error"]
    serial = time.perf_counter() - began
    began = time.perf_counter()
    from recount.plans import report

    rows = report._one_by_one(specs, cat, cat, "stop")
    assert [(r[0], r[4]) for r in rows] == [(1, 3), (2, 3), (3, None)] and "bad value" in rows[2][7]
    assert time.perf_counter() - began < 50 and serial < 50
