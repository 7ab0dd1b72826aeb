"""Grouped statistics, typed summaries and the shape report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FNS = {"avg": F.avg, "mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def group_stats(df: DataFrame, keys: Sequence[str], fns: Sequence[str] = ("avg",),
                cols: Sequence[str] | None = None) -> DataFrame:
    """``groupBy(keys).mean()/sum()/max()/min()`` over every numeric column,
    with stable names ``<fn>_<col>`` (``mean`` is named ``avg`` as in Spark)."""
    cols = list(cols) if cols is not None else numeric_columns(df, keys)
    aggs = []
    for fn in fns:
        name = "avg" if fn == "mean" else fn
        aggs += [_FNS[fn](c).alias(f"{name}_{c}") for c in cols]
    return df.groupBy(*keys).agg(*aggs)


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Typed long-form summary: one row per column with count, mean, stddev
    (sample), min and max as numbers.  One aggregation pass for all columns,
    then an unpivot of the single result row."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def summary_mixed(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int = 100_000) -> DataFrame:
    """One row per column of any atomic type, from one aggregation pass.

    ``n``, ``n_null``; for numbers mean, stddev (sample), min_number, q25, q50,
    q75 (quantile states of rank error 1 / ``accuracy``) and max_number; min_text
    and max_text for strings; min_time and max_time for dates and timestamps.
    """
    cols = list(cols) if cols is not None else df.columns
    kinds = {c: df.schema[c].dataType for c in cols}
    none = F.lit(None)
    aggs, rows = [F.count(F.lit(1)).alias("all")], []
    for i, c in enumerate(cols):
        number = isinstance(kinds[c], T.NumericType)
        text = isinstance(kinds[c], T.StringType)
        time = isinstance(kinds[c], (T.DateType, T.TimestampType, T.TimestampNTZType))
        aggs.append(F.count(c).alias(f"n{i}"))
        if number:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}")]
        if number or text or time:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]

        def of(name: str, kind: str, holds: bool, i=i):
            return (F.col(f"{name}{i}") if holds else none).cast(kind)

        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c].simpleString()).alias("type"), F.col(f"n{i}").alias("n"), (F.col("all") - F.col(f"n{i}")).alias("n_null"),
            of("m", "double", number).alias("mean"), of("s", "double", number).alias("stddev"), of("lo", "double", number).alias("min_number"),
            *((F.col(f"q{i}")[k] if number else none).cast("double").alias(f"q{p}") for k, p in enumerate((25, 50, 75))),
            of("hi", "double", number).alias("max_number"), of("lo", "string", text).alias("min_text"), of("hi", "string", text).alias("max_text"),
            of("lo", "timestamp_ntz", time).alias("min_time"), of("hi", "timestamp_ntz", time).alias("max_time")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def shape_report(df: DataFrame) -> DataFrame:
    """Schema rows (name, type, position) with the row and column counts."""
    spark = df.sparkSession
    schema_rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(schema_rows, "ordinal int, column_name string, data_type string")
    n_rows = df.agg(F.count(F.lit(1))).scalar()          # one value, computed once
    return (meta.withColumn("n_rows", n_rows)
                .withColumn("n_columns", F.lit(len(df.columns))))
