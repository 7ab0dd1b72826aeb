"""Plan-shape checks: pushdown, no Python in the hot path, broadcast of small sides."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tessera.session import scratch_path


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_python(spark):
    plan = executed(entry.queries()["heatmap_cells"](spark, SF_SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_scan_parquet_pushes_filters_and_prunes(spark):
    df = entry.queries()["scan_parquet"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate" in plan


def test_partition_range_prunes_directories(spark):
    df = entry.queries()["scan_partition_range"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eventdate" in plan


def test_enrichment_join_is_broadcast_for_small_dimension(spark):
    plan = executed(entry.queries()["enrich_left_join"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_pipeline_has_no_python(spark):
    plan = executed(entry.queries()["heatmap_pipeline"](spark, SF_SMALL))
    assert "EvalPython" not in plan


def test_flagship_aggregates_partially_before_shuffle(spark):
    plan = executed(entry.queries()["heatmap_cells"](spark, SF_SMALL))
    assert "partial_count" in plan and "Exchange hashpartitioning" in plan
    assert "SinglePartition" not in plan


def test_dedup_by_key_is_map_side(spark):
    plan = executed(entry.queries()["dedup_by_key"](spark, SF_SMALL))
    assert "partial_min" in plan


def test_sample_export_scans_with_a_task_per_split(spark):
    from tessera.operators.topn import top_n
    from tessera.plans import fixtures as fx
    path = scratch_path(spark, "splits")
    fx.table(spark, SF_SMALL, "lineitem").repartition(40).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        splits = spark.read.parquet(path).rdd.getNumPartitions()
        plan = executed(top_n(spark.read.parquet(path), 10, ["l_orderkey"], fan_in=4))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits >= 40 and "Coalesce" not in plan
    assert plan.count("REPARTITION_BY_NUM") >= 2 and "TakeOrderedAndProject" in plan  # levels: 40 or more, a quarter, a sixteenth


def test_bucketed_tables_join_and_total_without_exchange(spark):
    from tessera.plans.q_io import bucketed_fleet
    from tessera.operators.enrich import enrich_left
    tel, assets = bucketed_fleet(spark, SF_SMALL)
    joined = enrich_left(tel, assets.hint("merge"), "vehicleId", "asset_number").groupBy("vehicleId").count()
    plan = executed(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_cell_state_scans_once_without_expand(spark):
    from tessera.operators.distinct_state import cell_state, state_counts
    df = spark.range(100).select((F.col("id") % 5).alias("c"), *((F.col("id") % k).alias(f"f{k}") for k in (2, 3, 4)))
    plan = executed(state_counts(cell_state(df, ["c"], ["f2", "f3", "f4"])))
    assert "Expand" not in plan and plan.count("Range (") == 1


def test_rebalance_splits_a_skewed_key(spark):
    from tessera.operators.columns import rebalance
    df = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = scratch_path(spark, "rebalanced")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        rebalance(df, "k").write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = (spark.read.parquet(path).withColumn("file", F.input_file_name()).groupBy("k")
            .agg(F.countDistinct("file").alias("p"), F.count("*").alias("n")).collect())
    got = {r.k: r for r in back}
    assert got[0].p >= 3 and sum(r.n for r in back) == 60000


def test_heatmap_job_run_again_leaves_the_table_alone(spark):
    from tessera.functions.timefmt import parse_event_time
    from tessera.operators.pipeline import heatmap_job
    from tessera.plans import fixtures as fx
    from tessera.sources import sinks
    days = fx.telemetry(spark, SF_SMALL, "wide").withColumn("eventdate", F.to_date(parse_event_time("eventDateTime")))
    source, target = scratch_path(spark, "tel"), scratch_path(spark, "heat")
    sinks.write_parquet(days, source, partition_by=["eventdate"])
    name, assets = "job_" + target.rsplit("-", 1)[-1], fx.asset_dimension(spark, SF_SMALL)
    run = lambda a, b: {(r.eventdate.isoformat(), r.n) for r in heatmap_job(spark, source, a, b, assets, target, name).groupBy("eventdate").agg(F.count("*").alias("n")).collect()}
    first = run("2024-01-05", "2024-01-09")
    assert run("2024-01-05", "2024-01-09") == first
    both = run("2024-01-08", "2024-01-12")
    assert first <= both and {d for d, _ in both} == {f"2024-01-{d:02d}" for d in range(5, 13)}


def test_sql_arguments_leave_views_alone(spark):
    spark.range(3).createOrReplaceTempView("books")
    spark.range(4).createOrReplaceTempView("docs")
    for key in ("sql_limit", "sql_select_view", "sql_theme_counts", "sql_rule_counts", "sql_cell_counts"):
        entry.queries()[key](spark, SF_SMALL).count()
    assert spark.table("books").count() == 3 and spark.table("docs").count() == 4
    groups = {r.part_group for r in entry.queries()["sql_rule_counts"](spark, SF_SMALL).collect()}
    assert len(groups) == 8  # each of the seven rules, and the rest
    for view in ("books", "docs"):
        spark.catalog.dropTempView(view)


def test_states_roll_up_like_a_fresh_count(spark):
    from tessera.operators.distinct_state import cell_state, exact_pairs, pair_counts, roll_up, state_counts
    df = spark.range(0, 5000, 1, 6).select((F.col("id") % 40).alias("fine"), F.when(F.col("id") % 40 >= 5, F.col("id") % 4).alias("coarse"),
                                           F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("a"), (F.col("id") % 3).cast("string").alias("b"),
                                           F.lit(None).cast("int").alias("never"), (F.col("id") % 1000).alias("v"))
    state = cell_state(df, ["fine", "coarse"], ["a", "b", "never"], ["v"])
    got = {r.coarse: (r.n_rows, r.a_count, r.b_count, r.never_count) for r in state_counts(roll_up(state, "coarse")).collect()}
    want = df.groupBy("coarse").agg(F.count("*"), F.countDistinct("a"), F.countDistinct("b"), F.countDistinct("never"), F.countDistinct("v")).collect()
    assert got == {r[0]: tuple(r)[1:5] for r in want}
    assert {r[0]: r[1] for r in pair_counts(exact_pairs(df, ["fine", "coarse"], "v"), "coarse", "v").collect()} == {r[0]: r[5] for r in want}
    for r in state_counts(roll_up(state, "coarse")).collect():
        assert abs(r.v_approx - {w[0]: w[5] for w in want}[r.coarse]) <= 0.1 * r.v_approx + 1
    assert state_counts(roll_up(cell_state(df.limit(0), ["fine", "coarse"], ["a"]), "coarse")).count() == 0
