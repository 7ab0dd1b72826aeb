"""Checked column operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_checked(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``withColumnsRenamed`` that raises on a missing source column.

    Spark silently ignores a rename of a column that does not exist (the
    reference loses a ``count(vehicleId)`` rename that way).
    """
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(mapping)


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast columns in place.  Strict casts fail the job on malformed text
    (ANSI); ``lenient=True`` uses ``try_cast`` and gives NULL instead."""
    out = df
    for c, t in types.items():
        if c not in df.columns:
            raise KeyError(f"no column {c}")
        out = out.withColumn(c, F.col(c).try_cast(t) if lenient else F.col(c).cast(t))
    return out


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key together in partitions of like size (``REBALANCE``): their number follows the
    data at run time, small ones are joined and a key with much of the data takes several."""
    return df.hint("rebalance", *keys)
