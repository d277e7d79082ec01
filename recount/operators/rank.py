"""Keep one row per key (W1-W3): ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1``.

Spark plans ``row_number`` + ``= 1`` as a partial ``WindowGroupLimit`` before the shuffle and a
final one after it, so each map task forwards at most one row per key: a key that holds a
third of the table costs one row per map task in the exchange, not a third of the table in
one reducer.

The reference's orders leave ties (``ORDER BY user_id`` inside ``PARTITION BY user_id``), so
which row it keeps is arbitrary. Here every call passes a tie-break that completes the order,
which makes the kept row deterministic and repeatable across task retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pg import ColumnOrName, col


def first_per_key(
    df: DataFrame,
    keys: Sequence[ColumnOrName],
    order: Sequence[Column],
    rank_col: str | None = None,
) -> DataFrame:
    """Rows with ``row_number() = 1`` per ``keys`` under ``order``.

    ``order`` holds sort expressions with explicit null placement (``pg.desc``/``pg.asc``).
    ``rank_col`` keeps the rank as a bigint column of that name (always 1), as some extracts
    output it.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    if rank_col:
        return out.withColumn(rank_col, F.col(rank_col).cast("bigint"))
    return out.drop(name)
