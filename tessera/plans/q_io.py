"""Queries of the sources / sinks group (§2.1, §2.2).

Round trips write a driver table to a fresh folder under the shared scratch
root (``spark.checkpoint.dir``) and read it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.timefmt import parse_event_time
from tessera.operators.enrich import enrich_left, prepare_assets
from tessera.operators.pipeline import heatmap_job
from tessera.plans import fixtures as fx
from tessera.plans.q_geo import HEATMAP_CELLS_SQL, PIPELINE_SQL, heatmap_cells
from tessera.plans.registry import query
from tessera.plans.sqlgen import PEOPLE_SQL, clean_assets_sql, telemetry_sql
from tessera.session import scratch_path
from tessera.sources import readers, sinks


@query("scan_parquet", """SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_quantity > 30""")
def scan_parquet(spark, sf):
    """Filter and projection reach the scan (PushedFilters, narrow ReadSchema)."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return (li.filter((F.col("l_shipdate") >= F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
                      & (F.col("l_quantity") > 30))
              .select("l_orderkey", "l_quantity", "l_extendedprice"))


def _events_by_day(spark, sf):
    path = scratch_path(spark, "events-by-day")
    ev = fx.table(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("eventdate"))
    sinks.write_parquet(ev, path, partition_by=["eventdate"])
    return path


_RANGE_SQL = """SELECT event_id, value, CAST(ts AS DATE) AS eventdate FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"""


@query("scan_partition_range", _RANGE_SQL)
def scan_partition_range(spark, sf):
    path = _events_by_day(spark, sf)
    return readers.read_partition_range(spark, path, "eventdate", "2024-01-10", "2024-01-19") \
                  .select("event_id", "value", "eventdate")


@query("scan_partition_glob", _RANGE_SQL)
def scan_partition_glob(spark, sf):
    """The reference's glob over daily folders, keeping the partition column via basePath."""
    path = _events_by_day(spark, sf)
    return readers.read_partition_glob(spark, path, "eventdate=2024-01-1*") \
                  .select("event_id", "value", "eventdate")


def _part_csv(spark, sf, header):
    path = scratch_path(spark, "part-csv")
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    part.write.option("header", str(header).lower()).csv(path)
    return path


@query("scan_csv_raw", """SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_name AS _c1,
  CAST(p_retailprice AS VARCHAR) AS _c2 FROM part""")
def scan_csv_raw(spark, sf):
    return readers.read_csv(spark, _part_csv(spark, sf, False))


@query("scan_csv_header", """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
  CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""")
def scan_csv_header(spark, sf):
    return readers.read_csv(spark, _part_csv(spark, sf, True), header=True)


@query("scan_csv_infer", """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_retailprice FROM part""")
def scan_csv_infer(spark, sf):
    return readers.read_csv(spark, _part_csv(spark, sf, True), header=True, infer=True)


@query("scan_json", """SELECT p_partkey AS rank, p_name AS title, p_retailprice AS list_price,
  p_brand AS author FROM part""")
def scan_json(spark, sf):
    path = scratch_path(spark, "bestsellers-json")
    bs = fx.bestsellers(spark, sf)
    bs.select("rank", "title", "author", F.struct(F.col("price").alias("list")).alias("price")) \
      .write.json(path)
    back = readers.read_json(spark, path)                     # price comes back as a struct
    return back.select("rank", "title", F.col("price.list").alias("list_price"), "author")


@query("scan_text", "SELECT p_name AS value FROM part")
def scan_text(spark, sf):
    path = scratch_path(spark, "titles-text")
    fx.table(spark, sf, "part").select("p_name").write.text(path)
    return spark.read.text(path)


@query("scan_load", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_load(spark, sf):
    """The default source is parquet."""
    return spark.read.load(f"{sf.rstrip('/')}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


_REJECTS_SQL = """SELECT count(*) FILTER (WHERE NOT bad) AS n_good, count(*) FILTER (WHERE bad) AS n_rejects,
  round(sum(p_retailprice) FILTER (WHERE NOT bad), 4) AS good_price FROM (SELECT p_retailprice, p_partkey % 50 = 7 OR p_partkey % 77 = 3 AS bad FROM part)"""


def _good_and_rejects(good, rejects):
    both = good.select(F.lit(True).alias("good"), "p_retailprice").unionByName(rejects.select(F.lit(False).alias("good"), F.lit(None).cast("double").alias("p_retailprice")))
    return both.agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_rejects"), F.round(F.sum("p_retailprice"), 4).alias("good_price"))


@query("scan_csv_rejects", _REJECTS_SQL)
def scan_csv_rejects(spark, sf):
    """CSV by an explicit schema: a price that is no number, or a missing field, makes a line a reject."""
    price = F.when(F.col("p_partkey") % 50 == 7, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    whole = F.concat_ws(",", "p_partkey", "p_name", price)
    lines = fx.table(spark, sf, "part").select(F.when(F.col("p_partkey") % 77 == 3, F.concat_ws(",", "p_partkey", "p_name")).otherwise(whole))
    path = scratch_path(spark, "part-lines")
    lines.write.text(path)
    return _good_and_rejects(*readers.read_checked(spark, path, "p_partkey long, p_name string, p_retailprice double"))


@query("scan_json_rejects", _REJECTS_SQL)
def scan_json_rejects(spark, sf):
    """JSON lines by an explicit schema: broken lines and values of another type are rejects."""
    price = F.when(F.col("p_partkey") % 50 == 7, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    line = F.concat(F.lit('{"p_partkey": '), F.col("p_partkey"), F.lit(', "p_retailprice": '), F.when(price == "n/a", '"n/a"').otherwise(price), F.lit("}"))
    lines = fx.table(spark, sf, "part").select(F.when(F.col("p_partkey") % 77 == 3, F.rtrim(line, F.lit("}"))).otherwise(line))
    path = scratch_path(spark, "part-json-lines")
    lines.write.text(path)
    return _good_and_rejects(*readers.read_checked(spark, path, "p_partkey long, p_retailprice double", fmt="json"))


@query("sink_table_roundtrip", HEATMAP_CELLS_SQL)
def sink_table_roundtrip(spark, sf):
    path = scratch_path(spark, "heatmap-table")
    name = "heatmap_" + path.rsplit("-", 1)[-1]
    return sinks.write_table(heatmap_cells(spark, sf), name, path)


@query("sink_parquet_roundtrip", f"SELECT * FROM ({PEOPLE_SQL}) p")
def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "people-parquet")
    sinks.write_parquet(fx.people_with_gaps(spark, sf), path)
    return spark.read.parquet(path)


@query("sink_csv_roundtrip", """SELECT p_brand AS mobile, count(*) AS n FROM part GROUP BY p_brand""")
def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "brand-counts-csv")
    counts = fx.phone_survey(spark, sf).groupBy("mobile").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_csv(counts, path)
    return readers.read_csv(spark, path, header=True, schema="mobile string, n long")


@query("sample_export", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 25000""")
def sample_export(spark, sf):
    path = scratch_path(spark, "sample-csv")
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    sinks.sample_export(li, path, 25000, ["l_orderkey", "l_linenumber"])
    return readers.read_csv(spark, path, header=True,
                            schema="l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double")


_JOB_SQL = f"""SELECT geohash_7, "vehicleId", "eventDateTime", "VinCount", CAST("eventDateTime" AS DATE) AS eventdate FROM ({PIPELINE_SQL}) p
WHERE CAST("eventDateTime" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-24'"""


@query("heatmap_job", _JOB_SQL)
def heatmap_job_q(spark, sf):
    """Daily partitions to the heatmap table: two overlapping ranges, the days of both are written once each."""
    days = fx.telemetry(spark, sf, "wide", invalid_every=97).withColumn("eventdate", F.to_date(parse_event_time("eventDateTime")))
    source, target = scratch_path(spark, "telemetry-by-day"), scratch_path(spark, "heatmap-by-day")
    sinks.write_parquet(days, source, partition_by=["eventdate"])
    table = "heatmap_" + target.rsplit("-", 1)[-1]
    assets = fx.asset_dimension(spark, sf)
    heatmap_job(spark, source, "2024-01-10", "2024-01-19", assets, target, table)
    return heatmap_job(spark, source, "2024-01-15", "2024-01-24", assets, target, table).select(
        "geohash_7", "vehicleId", "eventDateTime", "VinCount", "eventdate")


def bucketed_fleet(spark, sf, buckets=8):
    """Telemetry and cleaned assets as tables bucketed by the vehicle."""
    tel = fx.telemetry(spark, sf, "wide").select("event_id", "vehicleId")
    assets = prepare_assets(fx.asset_dimension(spark, sf))
    out = []
    for df, key in ((tel, "vehicleId"), (assets, "asset_number")):
        path = scratch_path(spark, "bucketed")
        out.append(sinks.write_bucketed(df, "bucketed_" + path.rsplit("-", 1)[-1], path, key, buckets))
    return out


@query("bucketed_join_totals", f"""SELECT t."vehicleId", any_value(a.lob) AS lob, count(*) AS n_events
FROM ({telemetry_sql('wide')}) t LEFT JOIN ({clean_assets_sql()}) a ON t."vehicleId" = a.asset_number GROUP BY t."vehicleId" HAVING count(*) > 10""")
def bucketed_join_totals(spark, sf):
    """Join and totals on stored tables bucketed by the cleaned key: neither needs an exchange."""
    tel, assets = bucketed_fleet(spark, sf)
    joined = enrich_left(tel, assets.hint("merge"), "vehicleId", "asset_number")  # as for an asset table too large to broadcast
    return joined.groupBy("vehicleId").agg(F.any_value("lob").alias("lob"), F.count("*").alias("n_events")).where("n_events > 10")
