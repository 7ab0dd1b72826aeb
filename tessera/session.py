"""Session construction and the shared scratch location.

The library itself never needs a particular session configuration: every
operator is written to be correct under Spark's defaults (ANSI mode on, any
session time zone).  ``build_session`` is the recommended configuration for
jobs and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew join), UTC time zone and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 200),
        # Whole-stage code for geohash chains can exceed HotSpot's 8000-byte
        # JIT limit once a filter shares the stage; such a method would run
        # in the bytecode interpreter (about 4x slower here).
        "spark.driver.extraJavaOptions": JIT_OPTIONS,
        "spark.executor.extraJavaOptions": JIT_OPTIONS,
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset *and* Spark runs in local
    mode (tests, notebooks) a fresh local folder is created and registered;
    on a cluster an unset value is an error, because a machine-local folder
    is not visible to other executors.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at shared storage")
    root = tempfile.mkdtemp(prefix="tessera-scratch-")
    spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared scratch root (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write to the shared scratch root."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root if "://" in root else os.path.abspath(root))
    return root
