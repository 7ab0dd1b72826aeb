"""Heatmap aggregates (A7, A8, G6) and the composed pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.events import EVENT_FLAGS


def exact_key_counts(df: DataFrame, keys: Sequence[str], vehicle: str = "vehicleId",
                     out: str = "VinCount") -> DataFrame:
    """``groupBy(keys).agg(countDistinct(vehicle))`` when ``vehicle`` is one of the keys.

    With the vehicle inside the grouping key the distinct count is 1 per group
    (0 when the vehicle is NULL), so the aggregate is a row dedup plus a
    constant: one shuffle with map-side dedup instead of a distinct-count
    expansion.
    """
    keys = list(keys)
    if vehicle not in keys:
        raise ValueError("exact_key_counts needs the vehicle column inside the key")
    return (df.select(*keys).dropDuplicates(keys)
              .withColumn(out, F.when(F.col(vehicle).isNull(), 0).otherwise(1).cast("long")))


def cell_summary(df: DataFrame, cell: str = "geohash_7", vehicle: str = "vehicleId",
                 flags: Sequence[str] = EVENT_FLAGS, extra_keys: Sequence[str] = (),
                 approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per cell: rows, distinct vehicles and the total of every event flag.

    Partial aggregation runs map-side; the exact distinct count is planned as
    a two-stage aggregate keyed by (cell, vehicle) first, so one hot cell does
    not funnel its raw rows into one task.  ``approx=True`` uses a
    HyperLogLog++ sketch (``approx_count_distinct``, relative error ``rsd``)
    instead: one aggregation stage, fixed-size state per cell.
    """
    distinct = F.approx_count_distinct(vehicle, rsd) if approx else F.countDistinct(vehicle)
    aggs = [F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_vehicles")]
    aggs += [F.sum(F.col(f).cast("long")).alias(f"{f}_total") for f in flags]
    return df.groupBy(cell, *extra_keys).agg(*aggs)


def cell_rollup(df: DataFrame, fine: str = "geohash_7", coarse: str = "geohash_5",
                vehicle: str = "vehicleId") -> DataFrame:
    """Two-level counts: per coarse cell, its fine cells, rows and distinct vehicles.

    A fine cell belongs to exactly one coarse cell (prefix), so the counts are
    computed in one aggregation keyed by the coarse cell.
    """
    return (df.groupBy(coarse)
              .agg(F.countDistinct(fine).alias("n_fine_cells"),
                   F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct(vehicle).alias("n_vehicles")))
