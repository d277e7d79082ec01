"""Suite runs and the report.

All counts of a suite are planned together: table scans are fused per table, extracts become
one-row aggregates, and everything is unioned into one Spark job whose result has one row per
spec. Only that report (bounded by the number of specs, never by the data) reaches the
driver, and only in ``run_suite``/``write_report``/``show_report``.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.counts import row_count
from ..sources.catalog import Catalog
from .spec import Const, Extract, ReconSpec, Scan

log = logging.getLogger(__name__)

SOURCE, DEST = "source", "dest"

# Report columns and messages of the legacy report.
REPORT_COLUMNS = ["Source Table", "Destination Table", "Source Count", "Destination Count", "Result", "Comments"]
MATCH, MISMATCH = "count matches", "count mismatch"
NOT_MIGRATED = "Number of records not migrated : %d"
DEST_GREATER = "Destination count is greater than Source Count"
ALL_MIGRATED = "All records are migrated"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("suite", T.StringType()),
        T.StructField("Source Table", T.StringType()),
        T.StructField("Destination Table", T.StringType()),
        T.StructField("Source Count", T.LongType()),
        T.StructField("Destination Count", T.LongType()),
        T.StructField("Result", T.StringType()),
        T.StructField("Comments", T.StringType()),
    ]
)
ERROR_FIELD = T.StructField("Error", T.StringType())

_COUNT_ROW = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("side", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def verdict(src: Column, dst: Column) -> Column:
    """Equal counts match, anything else (including a missing count) does not."""
    return F.when(src == dst, F.lit(MATCH)).otherwise(F.lit(MISMATCH))


def comment(src: Column, dst: Column) -> Column:
    """How many records are missing, or that the destination has more."""
    return (
        F.when(src > dst, F.format_string(NOT_MIGRATED, F.abs(src - dst)))
        .when(src < dst, F.lit(DEST_GREATER))
        .otherwise(F.lit(ALL_MIGRATED))
    )


def with_verdict(counts: DataFrame, src: str = "Source Count", dst: str = "Destination Count") -> DataFrame:
    """Add ``Result`` and ``Comments`` to any frame of count pairs."""
    s, d = F.col(src), F.col(dst)
    return counts.withColumn("Result", verdict(s, d)).withColumn("Comments", comment(s, d))


# ---------------------------------------------------------------------------------------
# planning


def _extract_count(ord_: int, side_name: str, side: Extract, cat: Catalog) -> DataFrame:
    plan = side.count(cat) if side.count is not None else row_count(cat.derive(side.rows))
    return _count_frame(ord_, side_name, plan)


def _count_frame(ord_: int, side_name: str, plan: DataFrame) -> DataFrame:
    # One SQL expression per column: each Column-API call is a round trip to the JVM.
    n = plan.columns[0]
    return plan.selectExpr(f"CAST({int(ord_)} AS BIGINT) AS ord", f"'{side_name}' AS side", f"CAST(`{n}` AS BIGINT) AS n")


def _count_expr(scan: Scan, name: str) -> Column:
    if scan.where is None:
        return F.expr(f"count(1) AS {name}")
    if isinstance(scan.where, str):
        return F.expr(f"count_if({scan.where}) AS {name}")
    return F.count_if(scan.where).alias(name)


class _Counts:
    """Count plans of a suite, built once per spec side: extracts as one-row aggregates,
    scans grouped per (catalog, table) for fusion, constants as literal rows."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.frames: list[DataFrame] = []
        self.consts: list[tuple[int, str, int]] = []
        self.scans: dict[tuple[int, str], list[tuple[int, str, Scan]]] = defaultdict(list)
        self.tables: dict[tuple[int, str], DataFrame] = {}

    def add_spec(self, spec: ReconSpec, source: Catalog, dest: Catalog) -> None:
        """Plan both sides of ``spec``; raises (and adds nothing) if either cannot be planned."""
        staged_frames, staged_scans, staged_consts = [], [], []
        for side_name, side, cat in ((SOURCE, spec.source, source), (DEST, spec.dest, dest)):
            if isinstance(side, Const):
                staged_consts.append((spec.ord, side_name, int(side.value)))
            elif isinstance(side, Scan) and not cat.fuse_scans:
                staged_frames.append(_count_frame(spec.ord, side_name, cat.count(side.table, side.where)))
            elif isinstance(side, Scan):
                key = (id(cat), side.table)
                if key not in self.tables:
                    self.tables[key] = cat.table(side.table)
                if isinstance(side.where, str):  # resolve the predicate now, so errors surface here
                    self.tables[key].selectExpr(f"count_if({side.where})")
                elif side.where is not None:
                    self.tables[key].select(F.count_if(side.where))
                staged_scans.append((key, (spec.ord, side_name, side)))
            elif isinstance(side, Extract):
                staged_frames.append(_extract_count(spec.ord, side_name, side, cat))
            else:  # pragma: no cover
                raise TypeError(side)
        self.frames.extend(staged_frames)
        self.consts.extend(staged_consts)
        for key, member in staged_scans:
            self.scans[key].append(member)

    def count_frames(self) -> list[DataFrame]:
        """``ord, side, n`` frames covering every planned side."""
        frames = list(self.frames)
        for key, members in self.scans.items():
            df = self.tables[key]
            aggs = [_count_expr(s, f"c{i}") for i, (_, _, s) in enumerate(members)]
            rows = ", ".join(
                f"named_struct('ord', CAST({int(o)} AS BIGINT), 'side', '{sn}', 'n', CAST(c{i} AS BIGINT))"
                for i, (o, sn, _) in enumerate(members)
            )
            # One pass over the table however many specs count it (fused count_if), then one
            # row per spec side.
            frames.append(df.agg(*aggs).selectExpr(f"inline(array({rows}))"))
        if self.consts or not frames:
            frames.append(self.spark.createDataFrame(self.consts, _COUNT_ROW))
        return frames


def union_all(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of frames with the same columns, analysed once.

    Chaining ``DataFrame.union`` re-checks the growing plan at every step (quadratic in the
    number of specs); one SQL statement over the frames is analysed a single time."""
    if len(frames) == 1:
        return frames[0]
    args = {f"f{i}": f for i, f in enumerate(frames)}
    return spark.sql(" UNION ALL ".join(f"SELECT * FROM {{f{i}}}" for i in range(len(frames))), **args)


def _labels(spark: SparkSession, specs: Sequence[ReconSpec]) -> DataFrame:
    rows = [(s.ord, s.suite, s.source_label, s.dest_label) for s in specs]
    schema = "ord bigint, suite string, `Source Table` string, `Destination Table` string"
    return spark.createDataFrame(rows, schema)


def suite_report(
    specs: Sequence[ReconSpec],
    source: Catalog,
    dest: Catalog,
    on_error: str = "stop",
) -> DataFrame:
    """The report of a suite as one lazy DataFrame.

    ``on_error`` applies to specs that cannot be planned (missing table or column):
    ``'stop'`` keeps the specs before the first failing one, as the legacy loop does, and one row
    that names the failing spec, with null counts and the error as its comment;
    ``'isolate'`` keeps every spec and reports the failing ones with null counts and an
    ``Error`` column; ``'raise'`` re-raises.
    """
    spark = source.spark
    specs = sorted(specs, key=lambda s: s.ord)
    plan = _Counts(spark)
    good: list[ReconSpec] = []
    errors: dict[int, str] = {}
    for s in specs:
        try:
            plan.add_spec(s, source, dest)
            good.append(s)
        except Exception as e:  # analysis errors surface here, before any job runs
            if on_error == "raise":
                raise
            log.warning("spec %s %s -> %s cannot be planned: %s", s.ord, s.source_label, s.dest_label, e)
            errors[s.ord] = _text(e)
            if on_error == "stop":
                break
    kept = good + [s for s in specs if s.ord in errors]
    frames = plan.count_frames()
    args = {f"f{i}": f for i, f in enumerate(frames)}
    args["labels"] = _labels(spark, kept)
    union = " UNION ALL ".join(f"SELECT ord, side, n FROM {{f{i}}}" for i in range(len(frames)))
    # Union, pivot of the two sides and the label join in one statement: the plan of a suite
    # is large, and every separate DataFrame step would analyse it again.
    pairs = spark.sql(
        "SELECT l.ord, l.suite, l.`Source Table`, l.`Destination Table`, "
        "c.s AS `Source Count`, c.d AS `Destination Count` "
        "FROM {labels} l LEFT JOIN ("
        f"SELECT ord, max(CASE WHEN side = '{SOURCE}' THEN n END) AS s, max(CASE WHEN side = '{DEST}' THEN n END) AS d "
        f"FROM ({union}) u GROUP BY ord) c ON l.ord = c.ord",
        **args,
    )
    src_c, dst_c = F.col("Source Count"), F.col("Destination Count")
    report = pairs.select("*", verdict(src_c, dst_c).alias("Result"), comment(src_c, dst_c).alias("Comments"))
    cols = ["ord", "suite", *REPORT_COLUMNS]
    if on_error == "isolate" or errors:
        err = _error_frame(spark, errors)
        report = report.join(F.broadcast(err), "ord", "left")
        report = report.withColumn(
            "Result", F.when(F.col("Error").isNotNull(), F.lit(MISMATCH)).otherwise(F.col("Result"))
        ).withColumn("Comments", F.when(F.col("Error").isNotNull(), F.col("Error")).otherwise(F.col("Comments")))
    if on_error == "isolate":
        cols.append("Error")
    return report.select(*cols)


def _error_frame(spark: SparkSession, errors: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(list(errors.items()), "ord bigint, Error string")


def _text(e: BaseException) -> str:
    """The whole error."""
    return str(e).strip() or type(e).__name__


def _of_query(e: BaseException, spark: SparkSession) -> bool:
    """Whether an error is a query's own: not that of a stopped session or a cancelled job."""
    if not isinstance(e, (PySparkException, Py4JJavaError)) or spark.sparkContext._jsc.sc().isStopped():
        return False
    return "cancelled" not in str(e).lower()


def run_suite(
    specs: Sequence[ReconSpec],
    source: Catalog,
    dest: Catalog,
    on_error: str = "stop",
) -> DataFrame:
    """Run a suite now and return its report (bounded by the number of specs).

    The suite runs as one job. If that job fails (a database error, a bad value under ANSI
    casts), the specs are re-run one job each, ``RERUNS`` at a time, and ``on_error`` decides: ``'stop'``
    keeps the rows before the first failing spec and that spec's, with its error as the
    comment; ``'isolate'`` reports each failing spec with null counts and its error; ``'raise'``
    re-raises. Errors other than a query's (a lost cluster, a cancelled job) are always raised.
    """
    spark = source.spark
    try:
        rows = suite_report(specs, source, dest, on_error).collect()
        return spark.createDataFrame(rows, _schema(on_error))
    except Exception as e:
        if on_error == "raise" or not _of_query(e, spark):
            raise
        log.warning("suite job failed; re-running spec by spec", exc_info=True)
    return spark.createDataFrame(_one_by_one(sorted(specs, key=lambda s: s.ord), source, dest, on_error), _schema(on_error))


RERUNS = 8  # specs of a failed suite that run at a time


def _one_by_one(specs: Sequence[ReconSpec], source: Catalog, dest: Catalog, on_error: str) -> list[tuple]:
    """Rows of specs run as jobs of their own, several at a time. Under ``stop`` a failed spec cancels, by
    their tags, the jobs of those after it; the specs before it go on."""
    spark = source.spark
    context, run = spark.sparkContext, uuid.uuid4().hex
    tags = [f"recount-{run}-{i}" for i in range(len(specs))]
    lock, failed = threading.Lock(), [len(specs)]  # the first failed spec so far

    def one(i: int) -> tuple[list[tuple], BaseException | None]:
        if on_error == "stop" and failed[0] < i:
            return [], None
        context.addJobTag(tags[i])
        try:
            return [tuple(r) for r in suite_report([specs[i]], source, dest, "raise").collect()], None
        except Exception as e:
            if on_error == "stop":
                with lock:
                    if failed[0] < i:  # cancelled, or of no account
                        return [], None
                    failed[0] = i
                for tag in tags[i + 1 :]:
                    context.cancelJobsWithTag(tag)
            return [], e
        finally:
            context.removeJobTag(tags[i])

    with ThreadPoolExecutor(RERUNS) as pool:
        done = list(pool.map(one, range(len(specs))))
    out = []
    for s, (rows, e) in zip(specs, done):
        if e is not None:
            if isinstance(e, (PySparkException, Py4JJavaError)) and not _of_query(e, spark):
                raise e
            row = (s.ord, s.suite, s.source_label, s.dest_label, None, None, MISMATCH, _text(e))
            rows = [row]
        out += [r + ((_text(e) if e else None,) if on_error == "isolate" else ()) for r in rows]
        if e is not None and on_error == "stop":
            break
    return out


def _schema(on_error: str) -> T.StructType:
    if on_error == "isolate":
        return T.StructType(REPORT_SCHEMA.fields + [ERROR_FIELD])
    return REPORT_SCHEMA


def run_all(suites: Sequence[tuple[Sequence[ReconSpec], Catalog, Catalog]], on_error: str = "stop") -> DataFrame:
    """Every suite in one lazy report with a ``suite`` column.

    The legacy tool runs four scripts by hand; here the four suites are one plan, so their
    scans run side by side on the cluster."""
    reports = [suite_report(specs, src, dst, on_error) for specs, src, dst in suites]
    return union_all(reports[0].sparkSession, reports)


def write_report(report: DataFrame, path: str) -> None:
    """CSV with a header and the six legacy columns, one file.

    One file is right here: the report has one row per spec."""
    (
        report.orderBy("ord")
        .select(*REPORT_COLUMNS)
        .coalesce(1)
        .write.option("header", True)
        .mode("overwrite")
        .csv(path)
    )


def show_report(report: DataFrame) -> None:
    """Print every row and column (R9); a report has one row per spec."""
    rows = report.orderBy("ord").collect()
    report.sparkSession.createDataFrame(rows, report.schema).show(n=max(1, len(rows)), truncate=False)
