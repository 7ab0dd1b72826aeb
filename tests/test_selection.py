"""Exact imputation: own types, hot values, many columns in a fixed number of jobs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import selection
from tessera.operators.clean import impute


def filled(df, cols, strategy, **kw):
    row = impute(df, cols, strategy, **kw).where(F.coalesce(*(F.col(c).isNull() for c in cols))).first()
    return tuple(row[f"{c}_imputed"] for c in cols)


def test_types_are_kept(spark):
    big, fine = 2 ** 53 + 1, Decimal("12345678901234567890.123456789")
    df = spark.createDataFrame([(big, fine, 1.5, 2)] * 3 + [(big + 2, fine + 1, 2.5, 9), (None, None, None, None)],
                               "i long, d decimal(38,9), x double, s short")
    cols = ["i", "d", "x", "s"]
    assert filled(df, cols, "median") == (big, fine, 1.5, 2)
    assert filled(df, cols, "mode") == (big, fine, 1.5, 2)
    out = impute(df, cols, "median")
    assert [out.schema[f"{c}_imputed"].dataType for c in cols] == [df.schema[c].dataType for c in cols]


def test_mean_is_exact(spark):
    top = 2 ** 63 - 1
    df = spark.createDataFrame([(top, Decimal("0.01")), (top, Decimal("0.02")), (top - 2, Decimal("0.02")), (None, None)], "i long, d decimal(10,2)")
    assert filled(df, ["i", "d"], "mean") == (top - 1, Decimal("0.02"))
    halves = spark.createDataFrame([(1,), (2,), (None,)], "i int")
    assert filled(halves, ["i"], "mean") == (2,)


def test_median_equals_sorting(spark):
    rows = [((k * 7919) % 1013 if k % 3 else None, float("nan") if k % 5 == 0 else (k * 31 % 97) / 8, 5 if k % 3 else k) for k in range(2000)]
    df = spark.createDataFrame(rows, "a int, b double, c long").repartition(7)
    for i, c in enumerate("abc"):
        vals = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        got = selection.medians(selection.value_counts(df, ["a", "b", "c"]), 3)[i]
        assert got == vals[(len(vals) + 1) // 2 - 1], c


def test_columns_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a int, b double")
    for strategy in ("median", "mean", "mode"):
        assert [tuple(r) for r in impute(df, ["a", "b"], strategy).select("a_imputed", "b_imputed").collect()] == [(None, 1.0), (None, 1.0)]
        assert impute(df.limit(0), ["a", "b"], strategy).count() == 0


def test_equally_frequent_values_give_the_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,), (None,)], "a int")
    assert filled(df, ["a"], "mode") == (1,)


@pytest.mark.parametrize("strategy", ["median", "mode", "mean"])
def test_jobs_do_not_grow_with_columns(spark, strategy):
    tracker = spark.sparkContext.statusTracker()

    def jobs(k):
        df = spark.range(200).select(*((F.col("id") * (i + 1) % 17).alias(f"c{i}") for i in range(k)))
        spark.sparkContext.setJobGroup(f"impute-{strategy}-{k}", "")
        impute(df, df.columns, strategy)
        spark.sparkContext.setJobGroup("", "")
        return len(tracker.getJobIdsForGroup(f"impute-{strategy}-{k}"))

    assert jobs(1) >= jobs(6) - 1


def test_a_hot_value_is_added_up_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    plan = selection.value_counts(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # partial counts lie below the exchange
    assert selection.modes(selection.value_counts(df, ["v"]), 1) == {0: 7}
