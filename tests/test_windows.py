"""Windows and ids over range partitions against Spark's own windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.ids import with_sequential_id
from tessera.operators.windows import lag_lead_rank


def plain(df, key, order, value, rest):
    total = Window.partitionBy(key).orderBy(*order, *rest)
    return df.select(*df.columns, F.lag(value).over(total).alias(f"lag_{value}"), F.lead(value).over(total).alias(f"lead_{value}"),
                     F.rank().over(Window.partitionBy(key).orderBy(*order)).alias("rank"))


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


def test_groups_and_ties_over_many_partitions(spark):
    r = random.Random(2)
    rows = [(r.choice([None, None, "a", "a", "a", "b", f"k{r.randint(0, 30)}"]), r.choice([None, 1, 1, 1, 2, 3, r.randint(0, 500)]), float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, o int, v double").repartition(12)
    same(lag_lead_rank(df, "k", ["o"], "v"), plain(df, "k", ["o"], "v", ["v"]))


def test_one_key_and_one_tie_hold_everything(spark):
    df = spark.range(0, 5000, 1, 9).select(F.lit(None).cast("string").alias("k"), F.lit(7).alias("o"), F.col("id").alias("v"))
    same(lag_lead_rank(df, "k", ["o"], "v"), plain(df, "k", ["o"], "v", ["v"]))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "decimal(20,3)", "double", "binary", "date"])
def test_types_of_order_and_value(spark, kind):
    texts = {"timestamp": "2024-01-01 00:00:00.", "timestamp_ntz": "2024-01-01 00:00:00."}
    def value(n):
        if kind in texts:
            return F.concat(F.lit(texts[kind]), F.lpad(n.cast("string"), 6, "0")).cast(kind)  # differ in microseconds
        if kind == "date":
            return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
        return n.cast("string").cast("binary") if kind == "binary" else n.cast(kind)
    df = spark.range(0, 400, 1, 5).select((F.col("id") % 3).alias("k"), value(F.col("id") % 50).alias("o"), F.col("id").alias("v"),
                                          value(F.col("id") % 7).alias("w"))
    same(lag_lead_rank(df, "k", ["o"], "w"), plain(df, "k", ["o"], "w", ["v", "w"]))


def test_nan_and_signed_zero_are_ties(spark):
    df = spark.createDataFrame([("a", float("nan"), 1), ("a", float("nan"), 2), ("a", -0.0, 3), ("a", 0.0, 4), ("a", 1.0, 5)], "k string, o double, v int").repartition(4)
    got = {r.v: r["rank"] for r in lag_lead_rank(df, "k", ["o"], "v").collect()}
    assert got == {3: 1, 4: 1, 5: 3, 1: 4, 2: 4}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, o int, v double")
    assert lag_lead_rank(df, "k", ["o"], "v").count() == 0
    assert with_sequential_id(df, ["o"]).count() == 0


def test_one_range_shuffle_and_no_large_join(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.col("id").alias("v"))
    plan = lag_lead_rank(df, "k", ["o"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_equal_rows_span_partitions(spark):
    df = spark.range(0, 40000, 1, 8).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    ids = with_sequential_id(df, ["a"])
    per_task = [r.n for r in ids.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) >= 6 and max(per_task) < 15000
    assert ids.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 40000, 40000)
