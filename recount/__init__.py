"""recount: migration reconciliation on Spark.

Count what a migration should have moved (legacy extracts) against what arrived (destination
tables), suite by suite, in one Spark job; copy and account for stored objects the same way.
"""

from .operators.counts import left_join_count, row_count
from .operators.joins import left_join_fanout
from .operators.objects import copy_objects, copy_summary, list_objects, pending_objects, read_manifest
from .operators.rank import first_per_key
from .operators.surrogate import surrogate_id
from .plans.report import run_all, run_suite, show_report, suite_report, write_report
from .plans.spec import Const, Extract, ReconSpec, Scan, table_spec
from .sources.catalog import Catalog, FrameCatalog, JdbcCatalog, JdbcPartitioning, ParquetCatalog, TableCatalog

__all__ = [
    "Catalog", "Const", "Extract", "FrameCatalog", "JdbcCatalog", "JdbcPartitioning", "ParquetCatalog", "ReconSpec",
    "Scan", "TableCatalog", "copy_objects", "copy_summary", "first_per_key", "left_join_count", "left_join_fanout",
    "list_objects", "pending_objects", "read_manifest", "row_count", "run_all", "run_suite", "show_report",
    "suite_report", "surrogate_id", "table_spec", "write_report",
]
