"""Guarded sinks (K1-K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.topn import top_n


def write_table(df: DataFrame, name: str, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """Save as an external catalog table at ``path`` and return the table.

    (The reference chains ``.write...saveAsTable`` into an assignment, which
    leaves ``None`` behind; here the write is a statement and the table is
    returned.)
    """
    writer = df.write.mode(mode).format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] = (), dynamic: bool = False) -> None:
    """Parquet at ``path``; partitioned writes are clustered first, so each directory gets
    few files, and a directory with much of the data gets several of normal size.
    ``dynamic`` overwrites only the partitions that the rows belong to."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The external catalog table over Parquet at ``path``, made when it is not there, with its present partitions."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    table = spark.table(name)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
        table = spark.table(name)
    return table


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table bucketed and sorted by ``key``: joins and totals on it need no exchange.

    Rows are dealt to the buckets' tasks before the write, so there is one file per bucket.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """CSV with as many part files as the data has partitions, each with its header."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def sample_export(df: DataFrame, path: str, n: int, order: Sequence[str], header: bool = True,
                  fan_in: int = 16) -> DataFrame:
    """First ``n`` rows in a total ``order`` written as one CSV by Spark (no driver collect).

    The top n is reduced as a tree (``tessera.operators.topn.top_n``), so no
    task merges more than fan_in x n rows; the exported rows (at most n) are
    written through one task and returned.
    """
    sample = top_n(df, n, order, fan_in)
    sample.coalesce(1).write.option("header", str(header).lower()).csv(path)
    return sample
