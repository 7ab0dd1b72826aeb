"""Driving-event classification (G7-G9) and per-vehicle activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The four event flags and their labels, in the reference's order.
EVENT_FLAGS = ("rashturning", "overspeeding", "harshacceleration", "harshbrake")
EVENT_LABELS = {
    "rashturning": "rashturning_event",
    "overspeeding": "overspeeding_event",
    "harshacceleration": "harshacceleration_event",
    "harshbrake": "harshbrake_event",
}


def exclusive_condition(flag: str, flags: Sequence[str] = EVENT_FLAGS):
    """flag > 0 and every other flag == 0 (a NULL anywhere makes it not true)."""
    cond = F.col(flag) > 0
    for other in flags:
        if other != flag:
            cond = cond & (F.col(other) == 0)
    return cond


def classify_exclusive(df: DataFrame, flags: Sequence[str] = EVENT_FLAGS,
                       labels: dict | None = None, out: str = "event_type",
                       keep_unclassified: bool = False) -> DataFrame:
    """One pass: label each row with the single event class it belongs to.

    A row is in class X only when flag X is positive and all others are zero;
    overlapping and all-zero rows get no class and are dropped unless
    ``keep_unclassified``.  Replaces four filtered scans + a union.
    """
    labels = labels or EVENT_LABELS
    expr = None
    for flag in flags:
        cond = F.coalesce(exclusive_condition(flag, flags), F.lit(False))
        lab = F.lit(labels[flag])
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    out_df = df.withColumn(out, expr)
    return out_df if keep_unclassified else out_df.filter(F.col(out).isNotNull())


def classify_by_union(df: DataFrame, flags: Sequence[str] = EVENT_FLAGS,
                      labels: dict | None = None, out: str = "event_type") -> DataFrame:
    """The reference's form: one filter per class, constant label, UNION ALL.

    Kept as an equivalence oracle for ``classify_exclusive``; it scans the
    input once per class.
    """
    labels = labels or EVENT_LABELS
    parts = [df.filter(exclusive_condition(f, flags)).withColumn(out, F.lit(labels[f])) for f in flags]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def vehicle_totals(df: DataFrame, vehicle: str = "vehicleId", count_col: str | None = "VinCount",
                   min_total: int = 10, out: str = "totalVinCount") -> DataFrame:
    """Per vehicle: sum of ``count_col`` (or row count when None), kept when > ``min_total``."""
    agg = F.sum(count_col) if count_col else F.count(F.lit(1))
    return (df.groupBy(vehicle).agg(agg.cast("long").alias(out))
              .filter(F.col(out) > min_total))


def restrict_to_active(events: DataFrame, totals: DataFrame, vehicle: str = "vehicleId") -> DataFrame:
    """Inner join of classified events with the active-vehicle totals (one join, not four)."""
    return events.join(totals, vehicle)
