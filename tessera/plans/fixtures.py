"""Reference-shaped inputs derived from the driver tables.

Every derivation is a projection / join of the given parquet tables, so its
size grows with them.  The DuckDB twins of these derivations live in
``tessera.plans.sqlgen`` and must stay in step with this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.events import EVENT_FLAGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (parquet; Catalyst prunes columns and pushes filters)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _flag(modulus: int):
    return F.when(F.col("event_id") % modulus == 0, 1).otherwise(0)


# Coordinate generators of the two telemetry forms.
# wide form: 29 x 29 degree box over India, ~1 row per cell
# city form: 0.04 x 0.04 degree box, many rows per precision-7 cell
_FORMS = {
    "wide": (8.0, 68.0, 290000, 10000.0),
    "city": (18.5, 73.8, 40000, 1000000.0),
}
# vehicle ids are offset so that only part of them exist in the asset table
VEHICLE_OFFSET = 1400


def telemetry(spark: SparkSession, sf_dir: str, form: str = "city",
              invalid_every: int | None = None) -> DataFrame:
    """Vehicle telemetry rows from ``events``.

    Columns: event_id, vehicleId (string), eventDateTime (``yyyyMMddHHmm``
    digits), gpsLatitude, gpslongitude, the four event flags and idling.
    ``invalid_every=n`` moves every n-th event to the (90, 180) sentinel.
    """
    lat0, lon0, mod, div = _FORMS[form]
    uid, eid = F.col("user_id"), F.col("event_id")
    lat = F.lit(lat0) + ((uid * 7919 + eid * 104729) % mod) / F.lit(div)
    lon = F.lit(lon0) + ((uid * 15485863 + eid * 611953) % mod) / F.lit(div)
    if invalid_every:
        bad = eid % invalid_every == 0
        lat = F.when(bad, F.lit(90.0)).otherwise(lat)
        lon = F.when(bad, F.lit(180.0)).otherwise(lon)
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        (uid + VEHICLE_OFFSET).cast("string").alias("vehicleId"),
        F.date_format("ts", "yyyyMMddHHmm").alias("eventDateTime"),
        lat.alias("gpsLatitude"),
        lon.alias("gpslongitude"),
        _flag(5).alias("rashturning"),
        _flag(17).alias("idling"),
        _flag(7).alias("overspeeding"),
        _flag(11).alias("harshacceleration"),
        _flag(13).alias("harshbrake"),
    )


def asset_dimension(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Asset master from customer / nation / region.

    ``dirty=True`` reproduces the key pollution of the reference's asset
    table: every key is wrapped in tabs, and every third customer also has a
    clean copy (with a differently cased ``pl``) so deduplication must run
    after cleaning.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    base = (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .select(F.col("c_custkey").cast("string").alias("key"),
                     F.col("c_custkey"),
                     F.col("c_mktsegment").alias("lob"),
                     F.col("c_name").alias("pl"),
                     F.concat(F.lit("PPL-"), (F.col("c_custkey") % 40).cast("string")).alias("ppl"),
                     F.col("r_name").alias("dlr_region"),
                     F.col("n_name").alias("dlr_state"),
                     F.concat(F.lit("City-"), (F.col("c_custkey") % 97).cast("string")).alias("dlr_org_city"),
                     F.concat(F.lit("District-"), (F.col("c_custkey") % 31).cast("string")).alias("dlr_district")))
    cols = ["lob", "pl", "ppl", "dlr_region", "dlr_state", "dlr_org_city", "dlr_district"]
    if not dirty:
        return base.select(F.col("key").alias("asset_number"), *cols)
    tab = F.lit("\t")
    wrapped = base.select(F.concat(tab, F.col("key"), tab).alias("asset_number"), *cols)
    clean_copy = (base.filter(F.col("c_custkey") % 3 == 0)
                      .select(F.col("key").alias("asset_number"), "lob", F.lower("pl").alias("pl"),
                              *cols[2:]))
    return wrapped.unionByName(clean_copy)


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places (place_id, name, admin1, admin2, lat, lon) from nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(k.cast("long").alias("place_id"),
                     F.col("n_name").alias("name"),
                     F.col("r_name").alias("admin1"),
                     F.concat(F.lit("D"), k.cast("string")).alias("admin2"),
                     (F.lit(8.0) + ((k * 7907) % 290) / F.lit(10.0)).alias("lat"),
                     (F.lit(68.0) + ((k * 6133) % 290) / F.lit(10.0)).alias("lon")))


def phone_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone-survey shape (mobile, age, ratings, experience) from ``part``."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.col("p_brand").alias("mobile"),
                    F.col("p_size").alias("age"),
                    F.col("p_retailprice").alias("ratings"),
                    (F.col("p_partkey") % 20).cast("double").alias("experience"))


def bestsellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bestseller shape (title, author, rank, price, description, publisher) from part + documents."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("rank"),
                    F.col("p_name").alias("title"),
                    F.col("p_brand").alias("author"),
                    F.col("p_retailprice").alias("price"),
                    F.col("p_type").alias("publisher"),
                    F.col("p_size").alias("published_date"))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players shape (name, Rating, Country) from ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("name"),
                    (F.col("value") * 100).cast("long").cast("int").alias("Rating"),
                    F.col("event_type").alias("Country"))


def people_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People shape with NULLs (Name, age, Experience, Salary) from ``lineitem``.

    NULLs are manufactured by rule, identically in the DuckDB oracle:
    line 2 lacks age, line 3 lacks Experience and Salary, line 4 lacks
    everything but Salary.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.when(ln != 4, F.concat(F.lit("n"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                 ln.cast("string"))).alias("Name"),
        F.when(~ln.isin(2, 4), F.col("l_quantity").cast("int")).alias("age"),
        F.when(~ln.isin(3, 4), (F.col("l_orderkey") % 25).cast("int")).alias("Experience"),
        F.when(ln != 3, F.col("l_extendedprice")).alias("Salary"),
    )


__all__ = ["table", "telemetry", "asset_dimension", "gazetteer", "phone_survey",
           "bestsellers", "players", "people_with_gaps", "EVENT_FLAGS", "VEHICLE_OFFSET"]
