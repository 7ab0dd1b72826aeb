"""Guarded readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_partition_range(spark: SparkSession, base: str, column: str, start, end,
                         fmt: str = "parquet") -> DataFrame:
    """Rows of a ``column=value`` partitioned directory with start <= value <= end.

    Reads the table root (so the partition column is kept) and filters on the
    partition column: the filter becomes a ``PartitionFilters`` entry, so only
    matching directories are read (all are listed once to find the partitions).
    """
    df = spark.read.format(fmt).load(base)
    lo, hi = F.lit(start), F.lit(end)
    if isinstance(start, (dt.date, str)):
        lo, hi = lo.cast("date"), hi.cast("date")
    return df.filter(F.col(column).between(lo, hi))


def read_partition_glob(spark: SparkSession, base: str, pattern: str, fmt: str = "parquet") -> DataFrame:
    """Read ``base/pattern`` (e.g. ``eventdate=2023-12-*``) keeping the partition column.

    Without ``basePath`` Spark treats the matched directories as roots and the
    partition column disappears.
    """
    return spark.read.format(fmt).option("basePath", base).load(f"{base.rstrip('/')}/{pattern}")


def read_csv(spark: SparkSession, path: str, header: bool = False, infer: bool = False,
             schema=None) -> DataFrame:
    """CSV: no header gives ``_c0..`` string columns; ``infer`` costs an extra pass
    over the data, so production reads pass an explicit ``schema``."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON lines; nested objects become structs."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_checked(spark: SparkSession, path: str, schema: str, fmt: str = "csv", header: str | None = None,
                 sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Good rows by an explicit ``schema``, and the rejects as raw lines.

    ``fmt`` is csv or json, one record per line.  A line that does not give every
    field its type, or has too few or too many fields, is a reject; nothing is
    dropped in silence.  ``header`` is the header line, skipped in every file.
    Blank lines are neither.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    if header is not None:
        lines = lines.where(F.col("value") != header)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    full = f"{schema}, _corrupt string"
    parsed = (F.from_csv("value", full, {**options, "sep": sep}) if fmt == "csv" else F.from_json("value", full, options)).alias("r")
    rows = lines.select("value", parsed)
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return rows.where(~bad).select("r.*").drop("_corrupt"), rows.where(bad).select(F.col("value").alias("line"))
