"""Operator goldens and equivalence tests (native vs reference form, scalable vs plain)."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tessera.functions.text import clean_key
from tessera.operators import events as ev
from tessera.operators import udfs
from tessera.operators.clean import clean_keys_then_dedup, dedup_by_key, impute
from tessera.operators.columns import rename_checked
from tessera.operators.heatmap import exact_key_counts
from tessera.operators.ids import value_at_rank, with_sequential_id
from tessera.operators.windows import lag_lead_rank
from tessera.plans import fixtures as fx
from tessera.session import scratch_path
from tessera.sources import sinks


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


# ------------------------------------------------------------------ literal sources
BOATS = {"Boat": ["Tern", "Skua", "Petrel", "Heron", "Gull"], "Length": [12, 8, 30, 8, 14], "Port": ["Ystad", "Brest", "Ystad", "Brest", "Cork"]}


def test_columns_from_pandas(spark):
    df = spark.createDataFrame(pd.DataFrame(BOATS), schema=["boat", "Length", "Port"]).withColumn("Length", F.col("Length").cast("integer"))
    got = {r.Port: tuple(r)[1:] for r in df.groupBy("Port").agg(
        F.sum("Length").alias("s"), F.countDistinct("Length").alias("n"), F.avg("Length").alias("a")).collect()}
    assert got == {"Ystad": (42, 2, 21.0), "Brest": (16, 1, 8.0), "Cork": (14, 1, 14.0)}
    assert df.agg({"Length": "Sum"}).first()[0] == 72


def test_dict_of_lists_explode_ids(spark):
    crews = {"k1": ["Ada", "Bo"], "k2": ["Cy"], "k3": ["Di", "Ed", "Flo"]}
    df = spark.createDataFrame(list(crews.items()), "crew STRING, member ARRAY<STRING>")
    ids = with_sequential_id(df.withColumn("member", F.explode("member")), ["crew"], out="id", prefix="m")
    assert {r.id: r.member for r in ids.collect()} == {"m1": "Ada", "m2": "Bo", "m3": "Cy", "m4": "Di", "m5": "Ed", "m6": "Flo"}


def test_literal_points_geom_text(spark):
    from tessera.functions.text import coordinate_text
    df = spark.createDataFrame([(1, 59.3293, 18.0686), (2, -33.45, -70.667)], ["id", "lat", "lon"])
    got = [r.g for r in df.select(coordinate_text("lat", "lon", wrap=("(", ")")).alias("g")).orderBy("g").collect()]
    assert got == ["(-33.45, -70.667)", "(59.3293, 18.0686)"]


# ------------------------------------------------------------------ missing values
def test_thresh_keeps_rows_with_two_values(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1, None), (None, None, None)], "n string, x int, y int")
    assert rows(df.na.drop(how="any", thresh=2)) == [("b", 1, None)]


def test_string_fill_touches_only_strings(spark):
    df = spark.createDataFrame([(None, None)], "n string, x int")
    r = df.na.fill("Missing Values", ["n", "x"]).first()
    assert r.n == "Missing Values" and r.x is None


def test_exact_median_matches_imputer_exact(spark):
    from pyspark.ml.feature import Imputer
    pe = fx.people_with_gaps(spark, SF_SMALL)
    ours = impute(pe, ["age", "Experience", "Salary"], "median")
    theirs = Imputer(inputCols=["age", "Experience", "Salary"], outputCols=["a", "e", "s"],
                     strategy="median", relativeError=0.0).fit(pe).transform(pe)
    a = rows(ours, ["Name", "age_imputed", "Experience_imputed", "Salary_imputed"])
    b = rows(theirs, ["Name", "a", "e", "s"])
    assert a == b


def test_value_at_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 4, 2, 3, 2]], "v double")
    assert [value_at_rank(df, "v", k) for k in range(1, 7)] == [1.0, 2.0, 2.0, 3.0, 4.0, 5.0]


def test_bracketed_rank_equals_full_rank(spark):
    from tessera.operators.ids import value_at_rank_bracketed
    li = fx.table(spark, SF_SMALL, "lineitem").select(F.col("l_extendedprice").alias("v"))
    vals = sorted(r.v for r in li.collect())
    n = len(vals)
    for k in [1, 2, n // 3, (n + 1) // 2, n - 1, n]:
        assert value_at_rank_bracketed(li, "v", k, n, relative_error=0.01) == vals[k - 1]
    skew = spark.createDataFrame([(7.0,)] * 300 + [(float(i),) for i in range(100)], "v double")
    svals = sorted(r.v for r in skew.collect())
    for k in [1, 50, 200, 350, 400]:
        assert value_at_rank_bracketed(skew, "v", k, 400, relative_error=0.01) == svals[k - 1]


def test_impute_rejects_strings(spark):
    df = spark.createDataFrame([("1",)], "x string")
    with pytest.raises(TypeError):
        impute(df, ["x"])


# ------------------------------------------------------------------ keys, dedup, rename
def test_clean_key_strips_tabs(spark):
    df = spark.createDataFrame([("\t M\t",)], "k string")
    r = df.select(F.trim("k").alias("t"), clean_key("k").alias("c")).first()
    assert r.t == "\t M\t" and r.c == "M"


def test_clean_then_dedup_counts(spark):
    dirty = fx.asset_dimension(spark, SF_CHECK).select("asset_number", "lob", "pl")
    wrong = dirty.dropDuplicates(["asset_number"]).withColumn("asset_number", clean_key("asset_number"))
    right = clean_keys_then_dedup(dirty, "asset_number")
    assert wrong.count() == 2000 and right.count() == 1500
    assert right.select("asset_number").distinct().count() == 1500


def test_dedup_by_key_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([("k", 3, "x"), ("k", 1, "z"), ("k", 1, "y"), ("j", 2, "q")], "k string, a int, b string")
    once = dedup_by_key(df, ["k"], order=["a"])
    assert rows(once) == [("j", 2, "q"), ("k", 1, "y")]
    assert rows(dedup_by_key(once, ["k"], order=["a"])) == rows(once)


def test_rename_checked_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rename_checked(df, {"a": "New Name"}).columns == ["New Name"]
    with pytest.raises(KeyError):
        rename_checked(df, {"missing": "x"})


# ------------------------------------------------------------------ events and heatmap
def test_one_pass_classes_equal_union_form(spark):
    tel = fx.telemetry(spark, SF_CHECK, "wide")
    a = ev.classify_exclusive(tel).select("event_id", "event_type")
    b = ev.classify_by_union(tel).select("event_id", "event_type")
    assert rows(a) == rows(b)
    counts = {r.event_type: r["count"] for r in a.groupBy("event_type").count().collect()}
    assert counts == {"rashturning_event": 1438, "overspeeding_event": 959,
                      "harshacceleration_event": 576, "harshbrake_event": 480}


def test_null_flag_gets_no_class(spark):
    df = spark.createDataFrame([(1, None, 0, 0), (1, 0, 0, 0), (2, 0, 1, 1)],
                               "rashturning int, overspeeding int, harshacceleration int, harshbrake int")
    assert ev.classify_exclusive(df).count() == 1


def test_exact_key_counts_equal_count_distinct(spark):
    df = spark.createDataFrame([("c1", "v1", 1), ("c1", "v1", 1), ("c1", None, 1), ("c2", "v2", 0)],
                               "cell string, vehicleId string, f int")
    keys = ["cell", "vehicleId", "f"]
    literal = df.groupBy(*keys).agg(F.countDistinct("vehicleId").alias("VinCount"))
    assert rows(exact_key_counts(df, keys)) == rows(literal, keys + ["VinCount"])


# ------------------------------------------------------------------ ids and windows
def test_sequential_ids_equal_plain_window(spark):
    li = fx.table(spark, SF_CHECK, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    ours = with_sequential_id(li, ["l_orderkey", "l_linenumber"], out="id")
    plain = li.withColumn("id", F.row_number().over(Window.orderBy("l_orderkey", "l_linenumber", "l_quantity")))
    assert rows(ours) == rows(plain, ours.columns)
    n = li.count()
    assert ours.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, n, n)


def test_sequential_ids_plan_not_single_partition(spark):
    li = fx.table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber")
    plan = with_sequential_id(li, ["l_orderkey"], out="id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_lag_lead_rank_equal_window(spark):
    evs = fx.table(spark, SF_SMALL, "events").select("event_id", "user_id", "ts", "value")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = evs.select("event_id", F.lag("value").over(w).alias("lag_value"),
                       F.lead("value").over(w).alias("lead_value"), F.rank().over(w).alias("rank"))
    ours = lag_lead_rank(evs, "user_id", ["ts", "event_id"], "value")
    assert rows(ours, ["event_id", "lag_value", "lead_value", "rank"]) == rows(plain)


def test_lag_lead_rank_null_keys_and_order(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", None, 3.0), ("a", 1, 4.0), ("a", None, 5.0)],
                               "k string, o int, v double")
    w = Window.partitionBy("k").orderBy("o", "v")
    plain = df.select("v", F.lag("v").over(w).alias("lag_v"), F.lead("v").over(w).alias("lead_v"),
                      F.rank().over(Window.partitionBy("k").orderBy("o")).alias("rank"))
    ours = lag_lead_rank(df, "k", ["o"], "v")
    assert rows(ours, ["v", "lag_v", "lead_v", "rank"]) == rows(plain)


def test_rank_ties_share_rank(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("b", 5, 4.0)], "k string, o int, v double")
    got = {r.v: r["rank"] for r in lag_lead_rank(df, "k", ["o"], "v").collect()}
    assert got == {1.0: 1, 2.0: 1, 3.0: 3, 4.0: 1}




# ------------------------------------------------------------------ UDF twins and sinks
def test_udf_twins_equal_native(spark):
    df = spark.createDataFrame([("Apple", 25, 2.0, 3.0), ("MI", 31, 1.5, 2.0), (None, None, None, 1.0),
                                ("Vivo", 30, 4.0, 0.5)], "mobile string, age int, r double, e double")
    out = df.select(udfs.price_range("mobile").alias("a"), udfs.price_range_udf("mobile").alias("b"),
                    udfs.age_group("age").alias("c"), udfs.age_group_udf("age").alias("d"),
                    (100 - F.col("age")).alias("e"), udfs.years_remaining_udf("age").alias("f"),
                    (F.col("r") * F.col("e")).alias("g"), udfs.product_review_udf("r", "e").alias("h")).collect()
    for r in out:
        assert (r.a, r.c, r.e, r.g) == (r.b, r.d, r.f, r.h)


@pytest.mark.parametrize("n", [1, 7, 500, 5000])
def test_tree_top_n_equals_ordered_limit(spark, n):
    from tessera.operators.topn import top_n
    li = fx.table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity") \
           .repartition(37)
    ours = top_n(li, n, ["l_orderkey", "l_linenumber"], fan_in=3)
    plain = li.orderBy("l_orderkey", "l_linenumber", "l_quantity").limit(n)
    assert ours.collect() == plain.collect()


def test_csv_is_written_in_shards(spark):
    path = scratch_path(spark, "shards")
    sinks.write_csv(spark.range(0, 20, 1, 4), path)
    back = spark.read.option("header", "true").csv(path)
    assert sorted(int(r.id) for r in back.collect()) == list(range(20))
    assert back.select(F.input_file_name()).distinct().count() == 4


def test_drop_null_island_option(spark):
    from tessera.operators.geo import drop_invalid_cells, with_decoded, with_geohash
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 10.0), (90.0, 180.0)], "lat double, lon double")
    enc = with_decoded(with_geohash(df, "lat", "lon", 7), "geohash_7", 7)
    assert drop_invalid_cells(enc).count() == 2
    assert rows(drop_invalid_cells(enc, drop_null_island=True, cell="geohash_7"), ["lat"]) == [(10.0,)]


def test_impute_mode_and_mean(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (4,)], "x int")
    mode = impute(df, ["x"], "mode").filter(F.col("x").isNull()).first().x_imputed
    mean = impute(df, ["x"], "mean").filter(F.col("x").isNull()).first().x_imputed
    assert mode == 2 and mean == 2          # mean 2.25 rounds to 2, type stays int


def test_address_max_km(spark):
    from tessera.operators.places import with_address
    places = spark.createDataFrame([(1, "Town", "State", "Dist", 10.0, 10.0)],
                                   "place_id long, name string, admin1 string, admin2 string, lat double, lon double")
    pts = spark.createDataFrame([(1, 10.01, 10.0), (2, 40.0, 40.0)], "id int, la double, lo double")
    got = {r.id: r.address for r in with_address(pts, places, "la", "lo", max_km=50.0).collect()}
    assert got == {1: "Town, Dist, State", 2: None}


def test_write_table_partitioned(spark):
    ev = fx.table(spark, SF_SMALL, "events").select("event_id", F.to_date("ts").alias("d"))
    path = scratch_path(spark, "tbl")
    name = "t_" + path.rsplit("-", 1)[-1]
    back = sinks.write_table(ev, name, path, partition_by=["d"])
    assert back.count() == ev.count()
    assert "d" in back.columns



def test_dedup_before_join_equals_reference_order(spark):
    from tessera.operators.pipeline import enrich_telemetry, heatmap_from_telemetry, heatmap_table
    tel = fx.telemetry(spark, SF_SMALL, "city", invalid_every=97)
    tel = tel.unionByName(tel.filter(F.col("event_id") % 3 == 0))        # duplicate events
    assets = fx.asset_dimension(spark, SF_SMALL)
    a = heatmap_from_telemetry(tel, assets)
    b = heatmap_table(enrich_telemetry(tel, assets))
    assert rows(a) == rows(b, a.columns)


def test_hot_key_is_split_across_range_partitions(spark):
    """A key holding a third of the rows spans several range partitions, ids stay dense."""
    from tessera.operators.ids import _sort_keys
    base = spark.range(30000).select((F.col("id") % 1000).alias("user"), F.col("id").alias("t"))
    hot = spark.range(15000).select(F.lit(7).cast("long").alias("user"), (F.col("id") + 100000).alias("t"))
    df = base.unionByName(hot)
    parts = (df.repartitionByRange(8, *_sort_keys(df, ["user"], False))
               .filter(F.col("user") == 7).select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1
    ids = with_sequential_id(df, ["user"], out="id", partitions=8)
    n = df.count()
    assert ids.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, n, n)
    ranked = lag_lead_rank(df.withColumn("v", F.col("t").cast("double")), "user", ["t"], "v")
    hot_ranks = ranked.filter(F.col("user") == 7).agg(F.min("rank"), F.max("rank")).first()
    assert tuple(hot_ranks) == (1, 15000 + 30)


def test_event_time_ignores_the_session_zone(spark):
    from tessera.functions.timefmt import parse_event_time
    df = spark.createDataFrame([("202303120230",), ("bad",), ("202313010000",), (None,)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(parse_event_time("t").cast("string")).collect()]
            assert got == ["2023-03-12 02:30:00", None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dedup_order_may_name_a_key(spark):
    from tessera.operators.clean import dedup_by_key
    df = spark.createDataFrame([(1, 5), (1, 3), (2, 9)], "k int, v int")
    assert sorted(map(tuple, dedup_by_key(df, ["k"], ["k", "v"]).collect())) == [(1, 3), (2, 9)]
