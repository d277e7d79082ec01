"""Reconciliation specs: what to count on each side of a migrated table.

A spec pairs a *source side* (the legacy extract that defines what should have moved) with a
*destination side* (the migrated table). A side is one of:

* ``Scan(table, where)``  - count a catalog table, optionally filtered (S2, P3-P6). Scans of
  the same table are fused into one pass with ``count_if``;
* ``Const(n)``            - a count given as a literal (S3, ``select 2``);
* ``Extract(rows, count)`` - a DataFrame-producing extract (D1-D30); ``count`` optionally gives
  a cheaper plan with the same count (for example a fan-out join counted per key).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog


@dataclass(frozen=True, eq=False)
class Scan:
    """Count ``table``; ``where`` is a SQL predicate string or a Column."""

    table: str
    where: str | Column | None = None

    def predicate(self) -> Column | None:
        if isinstance(self.where, str):
            return F.expr(self.where)
        return self.where


@dataclass(frozen=True)
class Const:
    value: int


@dataclass(frozen=True, eq=False)
class Extract:
    rows: Callable[[Catalog], DataFrame]
    count: Callable[[Catalog], DataFrame] | None = None


Side = Scan | Const | Extract


@dataclass(frozen=True, eq=False)
class ReconSpec:
    suite: str
    ord: int
    source_label: str
    dest_label: str
    source: Side
    dest: Side


def table_spec(suite: str, ord: int, source_table: str, dest_table: str, dest_name: str | None = None) -> ReconSpec:
    """A full-table count on both sides; labels are the table names as written.

    ``dest_name`` is the name to read when it differs from the label (schema-qualified
    reserved words such as ``public.user``)."""
    return ReconSpec(suite, ord, source_table, dest_table, Scan(source_table), Scan(dest_name or dest_table))
