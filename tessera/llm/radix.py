"""Distributed LSD radix sort: dense ranks by stable counting-sort passes.

A composite key of integer columns is cut into digits, least significant first.
One pass holds rows in blocks of consecutive positions.  Each block counts its
digits; prefix sums over (digit, block) give every block the place where its
rows of each digit go; a row's new position is that place plus its rank among
the block's rows of its digit.  Passes are stable, so after the last one the
positions are the ranks of the whole key.

Blocks hold at most ``2**BLOCK_BITS`` rows however often a key repeats.  Digits
beyond the spread of a column's values need no pass.  Each pass reads the
written result of the one before, so a lost executor repeats one pass only.

Nulls of a key column come after its values; equal keys get different ranks, in
no stated order.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

DIGIT_BITS = 11
BLOCK_BITS = 15
SIGN = -(1 << 63)


def _offset(column: str, descending: bool, lo: int, hi: int) -> tuple[Column, int]:
    """The column as bits in an order that unsigned comparison follows, and how many of them differ.

    Nulls stand as 0: a pass of their own puts them last.
    """
    value = F.coalesce(F.col(column).cast("long"), F.lit(0))
    if hi - lo < 1 << 63:
        return (F.lit(hi) - value if descending else value - F.lit(lo)), (hi - lo).bit_length()
    return (F.bitwise_not(value) if descending else value).bitwiseXOR(F.lit(SIGN)), 64


def _digits(rows: DataFrame, keys: list[tuple[str, bool]]) -> list[Column]:
    """Digit columns of the composite key, least significant first, without digits that all rows share."""
    spread = rows.agg(*(f(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(f"{n}{i}")
                        for i, (c, _) in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))),
                      *(F.count_if(F.col(c).isNull()).alias(f"null{i}") for i, (c, _) in enumerate(keys))).first()
    out: list[Column] = []
    for i, (column, descending) in reversed(list(enumerate(keys))):
        value, bits = _offset(column, descending, spread[f"lo{i}"] or 0, spread[f"hi{i}"] or 0)
        out += [F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
                for at in range(0, bits, DIGIT_BITS)]
        if spread[f"null{i}"]:
            out.append(F.col(column).isNull().cast("int"))
    return out


def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting sort of ``_at`` (the position) by a digit."""
    held = rows.withColumns({"_block": F.shiftright("_at", BLOCK_BITS), "_digit": digit})
    counts = held.groupBy("_digit", "_block").agg(F.count("*").alias("n"))
    lower = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)  # one row a digit: 2**DIGIT_BITS at most
    firsts = counts.groupBy("_digit").agg(F.sum("n").alias("n")).select("_digit", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("first"))
    before = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    goes = (counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .join(F.broadcast(firsts), "_digit")
            .groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_digit", F.col("first") + F.col("ahead")))).alias("_goes")))
    own = Window.partitionBy("_block", "_digit").orderBy("_at")
    placed = (held.repartition("_block").withColumn("_rank", F.row_number().over(own) - 1)
              .join(goes, "_block").withColumn("_at", F.element_at("_goes", F.col("_digit")) + F.col("_rank")))
    return placed.drop("_block", "_digit", "_rank", "_goes")


def radix_rank(rows: DataFrame, keys: list[tuple[str, bool]], rank: str = "rank") -> DataFrame:
    """The rows with their rank from 1 by ``keys``, (integer column, descending) pairs, most significant first.

    Other columns travel along; ``_at``, ``_block``, ``_digit``, ``_rank`` and ``_goes`` are reserved.
    """
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "radix")
    for digit in _digits(rows, keys) or [F.lit(0)]:
        rows = stored(_pass(rows, digit), "radix")
    return rows.withColumn(rank, F.col("_at") + 1).drop("_at")
