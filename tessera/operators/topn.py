"""First n rows in a total order without merging n rows from every partition in one task.

``orderBy(...).limit(n)`` keeps the top n of each partition and then merges
n x (number of partitions) rows in a single task; at hundreds of thousands
of input partitions that one task reads billions of rows.  Here the top n is
reduced as a tree: each partition is sorted locally and cut to its first n
rows (no shuffle), then an exchange deals them to ``fan_in`` times fewer
partitions and the cut repeats, until at most ``fan_in`` partitions remain; the final
ordered limit merges at most fan_in x n rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _position_in_partition():
    return F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)


def total_order(df: DataFrame, order: Sequence[str]) -> list:
    names = list(order) + [c for c in df.columns if c not in order]
    return [F.col(c).asc_nulls_first() for c in names]


def top_n(df: DataFrame, n: int, order: Sequence[str], fan_in: int = 16) -> DataFrame:
    """The first ``n`` rows by ``order`` (ties broken by the other columns)."""
    keys = total_order(df, order)
    # partition count: metadata only for a scan-rooted input; an input with
    # shuffles gets its shuffle stages planned and run once by AQE here
    parts = df.rdd.getNumPartitions()
    level = df
    while True:
        level = (level.sortWithinPartitions(*keys)
                      .withColumn("__pos", _position_in_partition())
                      .filter(F.col("__pos") < n).drop("__pos"))
        if parts <= fan_in:
            break
        parts = -(-parts // fan_in)
        level = level.repartition(parts)  # an exchange: the scan keeps a task per split
    return level.orderBy(*keys).limit(n)
