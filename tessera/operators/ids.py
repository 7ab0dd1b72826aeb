"""Dense sequential ids over a global order without a one-task window.

``row_number()`` over an un-partitioned window moves every row into a single
partition.  Instead:

1. give every row a number of its own and fix it by a reliable ``checkpoint()``
   into the shared checkpoint folder: it is the last key of the order, so even
   rows equal in every column can lie in different partitions;
2. range-partition on the full order (the order columns, then every other
   column, then the row's number) into as many partitions as the input has, sort
   each, tag each row with its partition and its place there, and cut the
   lineage again, so a lost executor can never re-sample different range bounds;
3. count rows per range partition (a tiny table, one row per partition) and
   prefix-sum it into offsets, broadcast back (size bounded by the partition
   count);
4. id = offset of the partition + place inside the partition.

There is one range shuffle, no hash shuffle, and every task handles one
range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir


def _orderable(df: DataFrame, c: str) -> bool:
    def ok(t):
        if isinstance(t, T.MapType):
            return False
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True
    return ok(df.schema[c].dataType)


def _sort_keys(df: DataFrame, order: Sequence, descending: bool) -> list[Column]:
    keys = []
    named = set()
    for o in order:
        if isinstance(o, str):
            named.add(o)
            keys.append(F.col(o).desc_nulls_last() if descending else F.col(o).asc_nulls_first())
        else:
            keys.append(o)
    keys += [F.col(c).asc_nulls_first() for c in df.columns if c not in named and _orderable(df, c)]
    return keys


def range_sorted(df: DataFrame, order: Sequence, descending: bool = False, partitions: int | None = None) -> DataFrame:
    """The rows in range partitions by ``order``, then the other columns, each sorted, with ``__part`` and ``__pos``.

    The caller cuts the lineage before it uses the partitions a second time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = df.withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    keys = [*_sort_keys(df, order, descending), F.col("__row")]
    n = partitions or max(1, numbered.rdd.getNumPartitions())  # of a checkpoint: known without a job
    return (numbered.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
            .withColumn("__part", F.spark_partition_id())
            .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33)).drop("__row"))


def with_sequential_id(df: DataFrame, order: Sequence, out: str = "id",
                       prefix: str | None = None, partitions: int | None = None,
                       descending: bool = False) -> DataFrame:
    """Add ``out`` = 1..n following ``order`` (ties broken by the remaining columns).

    ``prefix="s"`` gives text ids ``s1, s2, ...`` like
    ``concat('s', row_number() over (order by ...))``.
    """
    tagged = range_sorted(df, order, descending, partitions).checkpoint()
    sizes = tagged.groupBy("__part").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    numbered = tagged.join(F.broadcast(offsets), "__part")
    seq = F.col("__off") + F.col("__pos") + F.lit(1)
    value = F.concat(F.lit(prefix), seq.cast("string")) if prefix is not None else seq
    cols = [c for c in df.columns if c != out]
    return numbered.select(value.alias(out), *cols)


def value_at_rank(df: DataFrame, col: str, rank: int):
    """The value with 1-based ``rank`` in ascending order of ``col`` (exact, distributed)."""
    ranked = with_sequential_id(df.select(col), [col], out="__rank")
    row = ranked.filter(F.col("__rank") == rank).select(col).first()
    return None if row is None else row[0]


def value_at_rank_bracketed(df: DataFrame, col: str, rank: int, n: int,
                            relative_error: float = 1e-4):
    """Exact value of 1-based ``rank`` among the ``n`` non-NULL values of ``col``.

    ``percentile_approx`` with accuracy 1/eps returns values whose rank is
    within eps*n of the target, so quantiles at q -+ 3*eps bracket the answer.
    One more pass counts the rows below the bracket and keeps the rows inside
    it (about 6*eps*n of them, plus ties), and only those are ranked exactly.
    No full sort of the column, nothing collected but three numbers.
    """
    if n <= 0 or not 1 <= rank <= n:
        return None
    eps = relative_error
    q = rank / n
    qs = [max(0.0, q - 3 * eps), min(1.0, q + 3 * eps)]
    accuracy = int(round(1.0 / eps))
    lo, hi = df.agg(F.percentile_approx(col, qs, accuracy)).first()[0]
    x = F.col(col)
    within = (x >= F.lit(lo)) & (x <= F.lit(hi))
    below, n_inside = df.agg(F.count_if(x < F.lit(lo)), F.count_if(within)).first()
    if not below < rank <= below + n_inside:
        # the bracket missed (it cannot under the documented error bound):
        # stay exact by ranking the whole column
        return value_at_rank(df, col, rank)
    return value_at_rank(df.filter(within).select(col), col, rank - below)
