"""Consecutive surrogate ids, ``ROW_NUMBER() OVER (ORDER BY ...)`` without one global task.

A plain ``row_number()`` over an un-partitioned window pulls every row into a single task.
Instead:

1. the input is written once to the shared folder, so that it is evaluated once: Spark's range
   partitioner reads its input for the sample and again for the exchange;
2. Spark's range partitioner deals the rows by the order, each partition is sorted and written with
   ``monotonically_increasing_id``: the partition's number and the place of the row within it;
3. the partitions' sizes (one row each) are summed up and broadcast;
4. id = rows in earlier partitions + place within the partition + 1.

No border passes the driver, and no expression grows with the number of partitions. The ids are
fixed when the frame is built: every evaluation reads the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

PLACE_BITS = 33  # of monotonically_increasing_id: the lower bits number a partition's rows


def surrogate_id(df: DataFrame, by: Sequence[str], name: str = "id", num_ranges: int | None = None) -> DataFrame:
    """Add ``name`` = 1, 2, ... in the ascending order of the columns ``by``, nulls last (they
    should determine the row's place, for stable ids). Runs two jobs when called."""
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(f"`{c}`").asc_nulls_last() for c in by]
    once = written(df, "numbering-input")
    dealt = once.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept = written(dealt.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", PLACE_BITS).cast("int")
    sizes = kept.groupBy(part.alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    # One row a partition: this window's single task has as many rows as there are partitions.
    before = F.sum("__n").over(Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__of", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    numbered = kept.join(F.broadcast(offsets), part == F.col("__of"))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + place + 1).cast("bigint").alias(name))
