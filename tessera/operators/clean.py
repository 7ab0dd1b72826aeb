"""Deduplication, key cleaning, missing values and exact imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import clean_key
from tessera.operators import selection


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the row with the smallest (``order``, then remaining columns).

    Written as ``min(struct(...))`` per key rather than a window: the minimum
    is computed partially on the map side, so a key holding a third of all
    rows never lands in one task as raw rows, and the survivor is
    deterministic (the reference's ``drop_duplicates(subset)`` keeps an
    arbitrary row).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order or [] if c not in keys]
    tail = [c for c in rest if c not in order]
    if not rest:
        return df.select(*keys).dropDuplicates(keys)
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in tail]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row._o{i}").alias(c) for i, c in enumerate(order)],
                         *[F.col(f"__row.{c}") for c in tail]).select(*df.columns)


def clean_keys_then_dedup(df: DataFrame, key: str, renames: dict | None = None) -> DataFrame:
    """Rename columns, strip all edge whitespace from ``key``, then deduplicate on it.

    Cleaning first matters: deduplicating dirty keys and trimming afterwards
    brings duplicates back and fans out a later join.
    """
    if renames:
        df = df.withColumnsRenamed(renames)
    return dedup_by_key(df.withColumn(key, clean_key(key)), [key])


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "median",
           suffix: str = "_imputed", exact: bool = True, relative_error: float = 0.001) -> DataFrame:
    """Fill NULL / NaN of ``cols`` into new ``<c>_imputed`` columns of the input type.

    ``strategy`` is median, mean or mode.  The exact median is the lower middle
    value (the element of rank ceil(n/2) among non-missing values), the mode
    the smallest of the most frequent values; both are selected from weighted
    (value, count) pairs of all columns at once and never leave their type.
    An integral mean is rounded to the nearest integer.  ``exact=False`` takes
    the median from ``percentile_approx`` with ``relative_error``.  The number
    of jobs does not depend on the number of columns.  Values found are applied
    as literals, like a fitted estimator; a column without values stays NULL.
    """
    cols = list(cols)
    for c in cols:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise TypeError(f"impute needs numeric columns, {c} is {df.schema[c].dataType.simpleString()}")
    if strategy == "mean":
        fills = selection.means(df, cols)
    elif strategy == "mode":
        fills = selection.modes(selection.value_counts(df, cols), len(cols))
    elif strategy == "median" and exact:
        fills = selection.medians(selection.value_counts(df, cols), len(cols))
    elif strategy == "median":
        accuracy = max(1, int(round(1.0 / relative_error)))
        fills = dict(enumerate(df.agg(*(F.percentile_approx(F.when(~selection.is_missing(df, c), F.col(c)), 0.5, accuracy).alias(str(i))
                                        for i, c in enumerate(cols))).first()))
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return df.withColumns({
        c + suffix: F.when(selection.is_missing(df, c), F.lit(fills.get(i)).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for i, c in enumerate(cols)})
