"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once (a lambda variable, so not inlined)."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column, pattern: str) -> Column:
    """All matches of a word pattern, in order; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and reread: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
