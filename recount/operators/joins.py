"""Joins whose right side fans out on a key that may be hot.

In ``L LEFT JOIN R ON key`` one key may hold a third of ``R``; Spark's adaptive skew handling can
split only the left side of a left join. ``left_join_fanout`` therefore is the union of

* the inner join, of which adaptive execution may split either side, or both, and
* the left rows without a partner (an anti join, whose left side may be split), null keys among
  them, with nulls for the right columns. The right side comes into it as its distinct keys, made
  distinct before the exchange: a hot key is one row per task.

Both joins deal the left side by the same key, so its exchange is reused: each large side is
exchanged once.

No key is counted, salted or treated apart, and there is no threshold: the same plan holds for
every size and every skew. Where only the row count is needed, ``counts.left_join_count`` avoids
the fan-out entirely.

Where a few keys hold all the rows of *both* sides (schedules and supermarkets by zone), the bytes of
a key are few and its product is not, so adaptive execution, which goes by bytes, leaves one task per
key. ``both_hot`` cuts the product of every key of more than ``BLOCK`` rows on a side into cells of
about ``BLOCK`` x ``BLOCK`` rows, which are dealt over the tasks: a left row goes to each of the key's
cells in its line, a right row to each in its column, so that every pair meets in one cell. The rows
sent are about 2 / ``BLOCK`` of the rows that come out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 2048  # rows of a side in a cell of a hot key's product


def left_join_fanout(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], both_hot: bool = False
) -> DataFrame:
    """``left LEFT JOIN right ON left_on = right_on``; column names of the two sides must differ.
    ``both_hot``: few keys hold the rows of both sides; their products are dealt over the tasks."""
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"rename overlapping columns first: {sorted(clash)}")
    if both_hot:
        met = _met_in_cells(left, right, left_on, right_on)
    else:
        met = left.join(right, _eq(left, right, left_on, right_on), "inner")
    keys = right.select(*right_on).distinct()
    alone = left.join(keys, _eq(left, keys, left_on, right_on), "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return met.select(*left.columns, *right.columns).unionByName(alone.select(*left.columns, *nulls))


def _met_in_cells(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    """The inner join, the product of a hot key cut into cells."""
    keys = [f"__k{i}" for i in range(len(left_on))]
    lines = _slices(left, left_on, keys, "__lines")
    columns = _slices(right, right_on, keys, "__columns")
    # At most one key for every BLOCK rows of the two sides; the keys with one cell are not among them.
    hot = F.broadcast(lines.join(columns, keys).filter("__lines > 1 OR __columns > 1"))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = [*keys, "__line", "__column"]
    l_ = _in_cells(left, left_on, keys, hot, ("__line", "__lines"), ("__column", "__columns")).repartition(n, *cell)
    r_ = _in_cells(right, right_on, keys, hot, ("__column", "__columns"), ("__line", "__lines")).repartition(n, *cell)
    return l_.join(r_, cell)


def _slices(df: DataFrame, on: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(on, keys)]).dropna().groupBy(*keys).count()
    return rows.select(*keys, F.ceil(F.col("count") / BLOCK).alias(name))


def _in_cells(
    df: DataFrame, on: Sequence[str], keys: Sequence[str], hot: DataFrame, own: tuple[str, str], other: tuple[str, str]
) -> DataFrame:
    """Each row in one slice of its own side, by a hash of the row, and in all of the other side's."""
    keyed = df.select("*", *[F.col(c).alias(k) for c, k in zip(on, keys)]).dropna(subset=list(keys))
    dealt = keyed.join(hot, list(keys), "left").fillna(1, ["__lines", "__columns"])
    return dealt.select(
        *df.columns, *keys, F.pmod(F.xxhash64(*df.columns), own[1]).alias(own[0]),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other[1]) - 1)).alias(other[0]),
    )


def _eq(a: DataFrame, b: DataFrame, a_on: Sequence[str], b_on: Sequence[str]) -> Column:
    cond = None
    for x, y in zip(a_on, b_on):
        c = a[x] == b[y]
        cond = c if cond is None else cond & c
    return cond


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Select ``columns`` (default all) renamed ``{prefix}_{name}``: explicit pruning and
    unique names before joins."""
    cols = columns if columns is not None else df.columns
    return df.selectExpr(*[f"`{c}` AS `{prefix}_{c}`" for c in cols])  # one call, not two per column
