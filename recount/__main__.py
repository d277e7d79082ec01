"""Command line: run a suite's reconciliation, or copy objects.

    python -m recount report --suite user [--source-jdbc URL | --source-parquet DIR]
                             [--dest-jdbc URL | --dest-parquet DIR] [--out PATH] [--on-error isolate]
                             [--partition TABLE=COLUMN[:TASKS] ...] [--unpartitioned error]
    python -m recount copy --src ROOT --dst ROOT [--prefix P] [--out PATH]

Without ``--source-*``/``--dest-*`` the databases come from numbered environment variables
``dbname{N} user{N} password{N} host{N} port{N}`` (PostgreSQL), as the legacy scripts read
them: the source is set 2 and each suite's destination has its own set.
"""

from __future__ import annotations

import argparse
import os
import sys

# Environment set of each database (source, and destination per suite).
SOURCE_ENV = 2
DEST_ENV = {"user": 1, "product": 3, "auth": 4, "order": 5}


def _jdbc_from_env(n: int) -> tuple[str, dict[str, str]]:
    host, port, db = os.environ[f"host{n}"], os.environ.get(f"port{n}", "5432"), os.environ[f"dbname{n}"]
    props = {"user": os.environ[f"user{n}"], "password": os.environ.get(f"password{n}", ""),
             "driver": "org.postgresql.Driver"}
    return f"jdbc:postgresql://{host}:{port}/{db}", props


def _partitioning(texts: list[str]):
    """``table=column`` or ``table=column:tasks`` -> how to split that table's reads."""
    from recount.sources.catalog import JdbcPartitioning

    out = {}
    for t in texts:
        table, _, rest = t.partition("=")
        column, _, n = rest.partition(":")
        if not table or not column:
            raise SystemExit(f"--partition {t}: expected table=column or table=column:tasks")
        out[table] = JdbcPartitioning(column, int(n) if n else 200)
    return out


def _catalog(spark, jdbc: str | None, parquet: str | None, env: int, partition: list[str], unpartitioned: str):
    from recount.sources.catalog import JdbcCatalog, ParquetCatalog

    split = _partitioning(partition)

    if parquet:
        return ParquetCatalog(spark, parquet)
    if jdbc:
        props = {"driver": "org.postgresql.Driver"}
        for k in ("user", "password"):
            v = os.environ.get(f"RECOUNT_JDBC_{k.upper()}")
            if v:
                props[k] = v
        return JdbcCatalog(spark, jdbc, props, split, unpartitioned=unpartitioned)
    url, props = _jdbc_from_env(env)
    return JdbcCatalog(spark, url, props, split, unpartitioned=unpartitioned)


def _session(args):
    from pyspark.sql import SparkSession

    from recount.session import local_session

    if args.local:
        return local_session(args.local)
    return SparkSession.builder.appName("recount").getOrCreate()


def report(args) -> int:
    from recount.plans.report import MATCH, run_suite, show_report, write_report
    from recount.plans.suites import all_suites

    spark = _session(args)
    suites = all_suites()
    names = list(suites) if args.suite == "all" else [args.suite]
    source = _catalog(spark, args.source_jdbc, args.source_parquet, SOURCE_ENV, args.partition, args.unpartitioned)
    status = 0
    for name in names:
        dest = _catalog(spark, args.dest_jdbc, args.dest_parquet, DEST_ENV[name], args.partition, args.unpartitioned)
        rep = run_suite(suites[name], source, dest, on_error=args.on_error)
        show_report(rep)
        if args.out:
            write_report(rep, os.path.join(args.out, f"{name}_db"))
        results = [r["Result"] for r in rep.select("Result").collect()]  # one per spec
        if len(results) < len(suites[name]):
            print(f"{name}: {len(results)} of {len(suites[name])} specs reported; the rest was not compared")
        if len(results) < len(suites[name]) or set(results) != {MATCH}:
            status = 1
    return status


def copy(args) -> int:
    from recount.operators.objects import copy_objects, copy_summary, ensure_target, list_objects, pending_objects

    spark = _session(args)
    ensure_target(args.dst)
    listing = list_objects(spark, args.src, args.prefix)
    if args.resume:
        listing = pending_objects(listing, list_objects(spark, args.dst, args.prefix))
    outcomes = copy_objects(listing, args.src, args.dst)
    if args.out:
        outcomes.write.mode("overwrite").parquet(args.out)
        outcomes = spark.read.parquet(args.out)
    summary = {r.status: (r.objects, r.bytes) for r in copy_summary(outcomes).collect()}
    if not summary:
        print(f"nothing found under {args.src} with prefix {args.prefix!r}")
    for status, (n, b) in sorted(summary.items()):
        print(f"{status}: {n} objects, {b} bytes")
    return 1 if "error" in summary else 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="recount")
    p.add_argument("--local", help="run on local[N] instead of the configured cluster")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("report", help="reconcile a suite (or all) and print / write the report")
    r.add_argument("--suite", choices=["auth", "order", "user", "product", "all"], required=True)
    r.add_argument("--source-jdbc")
    r.add_argument("--source-parquet")
    r.add_argument("--dest-jdbc")
    r.add_argument("--dest-parquet")
    r.add_argument("--partition", action="append", default=[], metavar="TABLE=COLUMN[:TASKS]",
                   help="split a database table's reads by ranges of a column")
    r.add_argument("--unpartitioned", choices=["warn", "error"], default="warn",
                   help="what to do before a database table is read whole by one task")
    r.add_argument("--out", help="folder for one CSV report per suite")
    r.add_argument("--on-error", choices=["stop", "isolate", "raise"], default="stop")
    c = sub.add_parser("copy", help="copy every object under a prefix to the same keys")
    c.add_argument("--src", required=True)
    c.add_argument("--dst", required=True)
    c.add_argument("--prefix", default="")
    c.add_argument("--resume", action="store_true", help="copy only keys missing from the target")
    c.add_argument("--out", help="where to write the per-object outcome rows")
    args = p.parse_args(argv)
    return report(args) if args.cmd == "report" else copy(args)


if __name__ == "__main__":
    sys.exit(main())
