"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from recount.plans.harness import REGISTRY
from tests.conftest import SF_SMALL

# The training-data operators have their own tests.
QUERIES = {k: q for k, q in entry.queries().items() if k in REGISTRY}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in REGISTRY}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from recount.sources.fixtures import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert df.columns == rel.columns
    got = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    want = Counter(tuple(_norm(v) for v in r) for r in rel.fetchall())
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 65
    assert df.columns == ["ord", "suite", "Source Table", "Destination Table", "Source Count", "Destination Count",
                          "Result", "Comments"]
    results = Counter(r["Comments"].split(" :")[0] for r in rows)
    assert set(results) == {"All records are migrated", "Number of records not migrated",
                            "Destination count is greater than Source Count"}
