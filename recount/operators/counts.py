"""Counting operators (R1, A1) and count-only shortcuts for fan-out joins.

``row_count`` keeps the count lazy: a one-row aggregate that Spark computes with a partial
count per task and one tiny exchange, reading no columns at all from parquet.

``left_join_count`` counts ``L LEFT JOIN R ON keys`` without building the product: per key,
``count_L(k) * max(count_R(k), 1)``; left rows with a null key match nothing and count once.
Both sides are pre-aggregated per key before the only shuffle (partial aggregation combines
map-side), so a key holding a third of either table costs one row per map task, and a
fan-out of billions of rows is never materialized.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    """``SELECT count(*) FROM (df)`` as a one-row DataFrame ``[name: bigint]``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(name))


def _key_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def left_join_count(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                    name: str = "count") -> DataFrame:
    """Row count of ``left LEFT JOIN right ON left_keys = right_keys`` as ``[name: bigint]``."""
    lk = [f"__k{i}" for i in range(len(left_keys))]
    lc = _key_counts(left.select(*[F.col(c).alias(k) for c, k in zip(left_keys, lk)]), lk, "__nl")
    rc = _key_counts(
        right.select(*[F.col(c).alias(k) for c, k in zip(right_keys, lk)]).dropna(subset=lk), lk, "__nr"
    )
    # Equi-join of two per-key count tables: one row per distinct key on each side. A null
    # left key finds no partner and keeps its own count.
    joined = lc.join(rc, on=lk, how="left")
    per_key = F.col("__nl") * F.greatest(F.coalesce(F.col("__nr"), F.lit(0)), F.lit(1))
    return joined.agg(F.coalesce(F.sum(per_key), F.lit(0)).cast("bigint").alias(name))
