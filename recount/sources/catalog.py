"""Catalogs: where a spec finds its tables.

A catalog maps a table name to a lazy DataFrame. Specs never open connections or read
files themselves; they ask a catalog, so one spec runs unchanged over a JDBC database,
a metastore, parquet folders or in-memory frames.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


class Catalog:
    """name -> DataFrame. Subclasses implement ``_load``; results are cached per name.

    ``fuse_scans``: whether several counts over one table should share one pass (right for
    files and tables Spark scans itself; wrong where each count can be answered by the
    source, as a database does)."""

    fuse_scans = True

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._cache: dict[str, DataFrame] = {}
        self._derived: dict[tuple, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        df = self._cache.get(name)
        if df is None:
            df = self._load(name)
            self._cache[name] = df
        return df

    __getitem__ = table

    def derive(self, fn: Callable[["Catalog"], DataFrame]) -> DataFrame:
        """``fn(self)``, built once per catalog: specs that read the same extract share one
        DataFrame (and so one plan, whose exchanges Spark can reuse)."""
        key = ("__derived__", fn)
        df = self._derived.get(key)
        if df is None:
            df = fn(self)
            self._derived[key] = df
        return df

    def _load(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def count(self, name: str, where: str | Column | None = None) -> DataFrame:
        """One row, the number of rows of ``name`` that ``where`` keeps."""
        df = self.table(name)
        if where is not None:
            df = df.filter(where)
        return df.agg(F.count(F.lit(1)).alias("n"))

    def names(self) -> list[str]:
        return sorted(self._cache)


class ParquetCatalog(Catalog):
    """Tables stored as ``{root}/{name}.parquet`` (file or folder) or ``{root}/{name}``."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet"):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.suffix = suffix

    def _load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")


class TableCatalog(Catalog):
    """Tables in the session catalog (metastore / Unity / Glue), optionally in one schema."""

    def __init__(self, spark: SparkSession, schema: str | None = None):
        super().__init__(spark)
        self.schema = schema

    def _load(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{name}" if self.schema else name)


@dataclass(frozen=True)
class JdbcPartitioning:
    """Parallel JDBC read: one query per range of ``column``; without it a table is one task.

    Leave ``lower``/``upper`` unset to have them read from the table
    (``SELECT min(column), max(column)``, answered by the database: one row comes back). These ranges are
    of equal width and need whole numbers. With ``by="quantiles"`` the database computes the borders
    of ranges of equal row counts, of a column of any type that sorts; a value that fills several of them is
    split further by ``spread``, a whole-number expression of a row (``hashtext(ctid::text)``)."""

    column: str
    num_partitions: int = 200
    lower: int | None = None
    upper: int | None = None
    by: str = "width"
    spread: str | None = None


def quantile_query(table: str, p: JdbcPartitioning) -> str:
    """PostgreSQL: the borders of ``num_partitions`` ranges of equal row counts, as text in their order, and how many
    ranges begin at each."""
    at = ", ".join(str(i / p.num_partitions) for i in range(1, p.num_partitions))
    cut = f"SELECT unnest(percentile_disc(ARRAY[{at}]) WITHIN GROUP (ORDER BY {p.column})) AS b FROM {table}"
    return f"SELECT CAST(b AS text) AS border, count(*) AS times FROM ({cut}) AS cut WHERE b IS NOT NULL GROUP BY b ORDER BY b"


def key_ranges(column: str, borders: Sequence[tuple[str, int]], spread: str | None = None) -> list[str]:
    """Conditions of which every row meets one: nulls and values below the first border, then from
    border to border. A border of several ranges is a value by itself, dealt by ``spread`` if it is given."""
    if not borders:
        return ["1 = 1"]
    text = ["'" + b.replace("'", "''") + "'" for b, _ in borders]
    out = [f"({column} < {text[0]} OR {column} IS NULL)"]
    for i, (_, times) in enumerate(borders):
        below = f" AND {column} < {text[i + 1]}" if i + 1 < len(borders) else ""
        if times > 1 and spread:
            # The remainder of a negative number is negative: both signs' remainders are dealt.
            out += [f"{column} = {text[i]} AND mod(mod({spread}, {times}) + {times}, {times}) = {j}" for j in range(times)]
            out.append(f"{column} > {text[i]}{below}")
        else:
            out.append(f"{column} >= {text[i]}{below}")
    return out


class JdbcCatalog(Catalog):
    """A relational database read over JDBC (the reference's PostgreSQL connections).

    ``partitioning`` gives per-table range splits so large tables are read by many tasks; a
    table without one is read by a single task, which ``unpartitioned="warn"`` reports and
    ``"error"`` refuses. ``fetchsize`` keeps the driver-side cursor from buffering whole tables.
    Counts are sent as a statement, ``SELECT count(*) FROM t WHERE ...``: one row crosses the
    wire. (Spark's own JDBC reader would stream a value per row: its aggregate push-down applies
    to catalog tables only.)
    """

    fuse_scans = False

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        partitioning: Mapping[str, JdbcPartitioning] | None = None,
        fetchsize: int = 10_000,
        unpartitioned: str = "warn",
    ):
        super().__init__(spark)
        self.url = url
        self.properties = dict(properties)
        self.partitioning = dict(partitioning or {})
        self.fetchsize = fetchsize
        self.unpartitioned = unpartitioned

    def _reader(self, name: str):
        reader = (
            self.spark.read.format("jdbc")
            .option("url", self.url)
            .option("dbtable", name)
            .option("fetchsize", str(self.fetchsize))
            .option("pushDownPredicate", "true")
        )
        for k, v in self.properties.items():
            reader = reader.option(k, v)
        return reader

    def _query(self, sql: str) -> DataFrame:
        return self._reader(f"({sql}) AS q").load()

    def bounds(self, name: str, p: JdbcPartitioning) -> tuple[int, int]:
        """The range of the partition column (given, or one pushed-down min/max row)."""
        if p.lower is not None and p.upper is not None:
            return p.lower, p.upper
        row = self._query(f"SELECT min({p.column}) AS lo, max({p.column}) AS hi FROM {name}").first()
        lo, hi = row["lo"], row["hi"]
        return (int(lo) if lo is not None else 0), (int(hi) if hi is not None else 0)

    def count(self, name: str, where: str | Column | None = None) -> DataFrame:
        if isinstance(where, Column):
            raise ValueError(f"count of {name}: give the condition as SQL text, which the database can evaluate")
        return self._query(f"SELECT count(*) AS n FROM {name}" + (f" WHERE {where}" if where else ""))

    def _load_parts(self, name: str, conditions: list[str]) -> DataFrame:
        """One task per condition."""
        reader = self.spark.read.option("fetchsize", str(self.fetchsize)).option("pushDownPredicate", "true")
        return reader.jdbc(self.url, name, predicates=conditions, properties=self.properties)

    def _load(self, name: str) -> DataFrame:
        reader = self._reader(name)
        p = self.partitioning.get(name)
        if p is None:
            said = f"{name} is read by one task: no partitioning is given for it"
            if self.unpartitioned == "error":
                raise ValueError(said)
            log.warning(said)
        if p is not None and p.by == "quantiles":
            borders = [(r["border"], r["times"]) for r in self._query(quantile_query(name, p)).collect()]
            return self._load_parts(name, key_ranges(p.column, borders, p.spread))
        if p is not None:
            lo, hi = self.bounds(name, p)
            reader = (
                reader.option("partitionColumn", p.column)
                .option("lowerBound", str(lo))
                .option("upperBound", str(hi + 1))
                .option("numPartitions", str(p.num_partitions))
            )
        return reader.load()


class FrameCatalog(Catalog):
    """Tables given directly as DataFrames or as functions producing them (tests, views)."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        super().__init__(spark)
        self.tables = dict(tables)

    def _load(self, name: str) -> DataFrame:
        t = self.tables[name]
        return t() if callable(t) else t

    def names(self) -> list[str]:
        return sorted(self.tables)
