"""Exact statistics of many columns at once from weighted (value, count) pairs.

All columns are counted in one pass: each row gives one pair per column, a
struct in which only that column's field is set, so values keep their own type
and no column needs a job of its own.  Equal values are added up before they
are shuffled, so a value that a third of the rows share is a few partial counts.

The median is a weighted selection.  Pairs are range-partitioned by (column,
value); per partition and column the counts are added up, a table of partitions
times columns; prefix sums over it tell in which partition each median lies;
only that partition's pairs are summed one by one.  Missing values (null, NaN)
are not counted.  Every function returns one row per column that has any value;
an empty table, or a column without values, gives none.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir


def _field(i: int) -> str:
    return f"v{i}"


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c.isNull()


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column (its place in ``cols``), v0 ... vk (only the column's own is set), n."""
    def pair(i: int) -> Column:
        fields = [(F.col(c) if j == i else F.lit(None)).cast(df.schema[c].dataType).alias(_field(j)) for j, c in enumerate(cols)]
        return F.struct(F.lit(i).alias("column"), (~is_missing(df, cols[i])).alias("known"), *fields)

    pairs = df.select(F.explode(F.array(*(pair(i) for i in range(len(cols))))).alias("p")).select("p.*").where("known")
    return pairs.groupBy("column", *(_field(i) for i in range(len(cols)))).agg(F.count("*").alias("n"))


def _own_values(rows: list) -> dict[int, object]:
    return {r["column"]: r[_field(r["column"])] for r in rows}


def medians(pairs: DataFrame, k: int) -> dict[int, object]:
    """Per column the value of rank ceil(n / 2), in the column's type."""
    values = [_field(i) for i in range(k)]
    ensure_checkpoint_dir(pairs.sparkSession)  # bounds are drawn from a sample: fix which pair lies where
    placed = pairs.repartitionByRange("column", *values).withColumn("part", F.spark_partition_id()).checkpoint()
    sums = placed.groupBy("column", "part").agg(F.sum("n").alias("held"))
    upto = Window.partitionBy("column").orderBy("part")
    cum = sums.select("column", "part", (F.sum("held").over(upto) - F.col("held")).alias("below"), "held",
                      F.sum("held").over(Window.partitionBy("column")).alias("total"))
    rank = F.ceil(F.col("total") / 2)
    where = cum.where((F.col("below") < rank) & (rank <= F.col("below") + F.col("held"))).select("column", "part", (rank - F.col("below")).alias("rank"))
    near = placed.join(F.broadcast(where), ["column", "part"])  # one row per column
    order = Window.partitionBy("column").orderBy(*values).rowsBetween(Window.unboundedPreceding, 0)
    found = near.withColumn("upto", F.sum("n").over(order)).where("upto >= rank and upto - n < rank")
    return _own_values(found.collect())


def modes(pairs: DataFrame, k: int) -> dict[int, object]:
    """Per column the most frequent value, the smallest of equally frequent ones."""
    values = [_field(i) for i in range(k)]
    best = pairs.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rarity"), *values)).alias("b")).select("column", "b.*")
    return _own_values(best.collect())


def means(df: DataFrame, cols: Sequence[str]) -> dict[int, object]:
    """Per column the mean: of exact sums for integers (rounded to an integer) and decimals (to their scale)."""
    kinds = [df.schema[c].dataType for c in cols]

    def total(c: str, kind: T.DataType) -> Column:
        own = F.when(~is_missing(df, c), F.col(c))
        return F.sum(own.cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else own)

    row = df.agg(*(total(c, t).alias(f"s{i}") for i, (c, t) in enumerate(zip(cols, kinds, strict=True))),
                 *(F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols))).first()
    out: dict[int, object] = {}
    for i, kind in enumerate(kinds):
        held, n = row[f"s{i}"], row[f"n{i}"]
        if not n:
            continue
        if isinstance(kind, (T.IntegralType, T.DecimalType)):
            scale = kind.scale if isinstance(kind, T.DecimalType) else 0
            with localcontext(prec=80):
                mean = (held / n).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
            out[i] = int(mean) if isinstance(kind, T.IntegralType) else mean
        else:
            out[i] = held / n
    return out
