"""Helpers shared by the operators: inputs, the shared folder, row identity, byte files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_dir, written  # noqa: F401

# The ASCII white space of the contracts, [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI: local, HDFS or object store. For use in tasks."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`"), F.lit(""))


def strip_ascii(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def words(c: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space; an empty array if there are none."""
    bare = strip_ascii(c)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_SPACE_RE))


def row_key(id_col: str, text: Column) -> list[Column]:
    """Identity of a row: its id and its text's hashes. Rows equal in both are one another's
    copies and get equal results, so grouping by this key loses nothing."""
    return [
        F.col(f"`{id_col}`").alias("__id"),
        F.xxhash64(text).alias("__t1"),
        F.hash(text).alias("__t2"),
    ]


KEY = ["__id", "__t1", "__t2"]


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows as one column ``__row``, so that no name of theirs can clash, and ``more``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *more)


def unpacked(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"__row.`{c}`").alias(c) for c in columns]


def null_safe(a: DataFrame, b: DataFrame, cols: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[prefix + c])
    return cond
