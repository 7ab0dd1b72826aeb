"""Queries of the telemetry / geohash / heatmap / geocoding theme (§2.10, A7-A10, G*, T1-T3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import coordinate_text
from tessera.functions.timefmt import month_name, parse_event_time
from tessera.operators import events as ev
from tessera.operators.distinct_state import cell_state, exact_pairs, pair_counts, roll_up, state_counts
from tessera.operators.geo import bounding_box, with_decoded, with_geohash
from tessera.operators.heatmap import cell_rollup, cell_summary
from tessera.operators.pipeline import HEATMAP_KEYS, enrich_telemetry, heatmap_from_telemetry, prepare_telemetry
from tessera.operators.places import nearest_place
from tessera.plans import fixtures as fx
from tessera.plans import sqlgen as sg
from tessera.plans.registry import query

FLAGS = ev.EVENT_FLAGS


# ---------------------------------------------------------------- G1 / G2 / G3
def _encoded(spark, sf, form="wide", prefixes=(5,)):
    tel = fx.telemetry(spark, sf, form)
    return with_geohash(tel, "gpsLatitude", "gpslongitude", 7, prefixes=prefixes)


_TEL_GH = sg.geohash_sql(sg.telemetry_sql("wide"), "gpsLatitude", "gpslongitude", 7)


@query("geohash_encode_7", f"SELECT event_id, geohash_7 FROM ({_TEL_GH}) t")
def geohash_encode_7(spark, sf):
    return _encoded(spark, sf, prefixes=()).select("event_id", "geohash_7")


_TEL_GH5 = sg.geohash_sql(sg.telemetry_sql("wide"), "gpsLatitude", "gpslongitude", 5)


@query("geohash_encode_5", f"SELECT event_id, geohash_5 FROM ({_TEL_GH5}) t")
def geohash_encode_5(spark, sf):
    return _encoded(spark, sf).select("event_id", "geohash_5")


_LAT, _LON = sg.centre_sql("geohash_7", 7, as_float=True)


@query("geohash_decode", f"""SELECT event_id, geohash_7,
  {_LAT} AS latitude, {_LON} AS longitude FROM ({_TEL_GH}) t""")
def geohash_decode(spark, sf):
    df = with_decoded(_encoded(spark, sf, prefixes=()), "geohash_7", 7, "lat_f", "lon_f",
                      array_out="decodedVal")
    # the reference splits the float array: element 0 is latitude, 1 is longitude
    return df.select("event_id", "geohash_7",
                     F.round(F.col("decodedVal")[0].cast("double"), 2).alias("latitude"),
                     F.round(F.col("decodedVal")[1].cast("double"), 2).alias("longitude"))


# ---------------------------------------------------------------- G5 / T5
@query("coordinate_text", f"""SELECT event_id,
  CAST(CAST({_LAT} AS FLOAT) AS VARCHAR) || ', ' || CAST(CAST({_LON} AS FLOAT) AS VARCHAR) AS coordinates,
  '(' || CAST(gpsLatitude AS VARCHAR) || ', ' || CAST(gpslongitude AS VARCHAR) || ')' AS geom
FROM ({_TEL_GH}) t""")
def coordinate_text_q(spark, sf):
    df = with_decoded(_encoded(spark, sf, prefixes=()), "geohash_7", 7, "Latitude", "Longitude")
    return df.select("event_id",
                     coordinate_text("Latitude", "Longitude").alias("coordinates"),
                     coordinate_text("gpsLatitude", "gpslongitude", wrap=("(", ")")).alias("geom"))


# ---------------------------------------------------------------- A8 flagship
_CITY_GH = sg.geohash_sql(sg.telemetry_sql("city"), "gpsLatitude", "gpslongitude", 7)
_CLAT, _CLON = sg.centre_sql("geohash_7", 7)
HEATMAP_CELLS_SQL = f"""SELECT geohash_7, geohash_5, n_rows, n_vehicles, rashturning_total,
  overspeeding_total, harshacceleration_total, harshbrake_total,
  {_CLAT} AS latitude, {_CLON} AS longitude
FROM (SELECT geohash_7, substr(geohash_7, 1, 5) AS geohash_5, count(*) AS n_rows,
  count(DISTINCT vehicleId) AS n_vehicles,
  CAST(sum(rashturning) AS BIGINT) AS rashturning_total,
  CAST(sum(overspeeding) AS BIGINT) AS overspeeding_total,
  CAST(sum(harshacceleration) AS BIGINT) AS harshacceleration_total,
  CAST(sum(harshbrake) AS BIGINT) AS harshbrake_total
  FROM ({_CITY_GH}) g GROUP BY geohash_7) c"""


@query("heatmap_cells", HEATMAP_CELLS_SQL)
def heatmap_cells(spark, sf):
    """Per precision-7 cell: rows, distinct vehicles, event totals, decoded centre.

    The centre is decoded after the aggregation: once per cell, not per row.
    """
    g = _encoded(spark, sf, form="city")
    cells = cell_summary(g, "geohash_7", "vehicleId", FLAGS, extra_keys=["geohash_5"])
    return with_decoded(cells, "geohash_7", 7, "latitude", "longitude", as_float=False)


@query("heatmap_rollup_5", f"""SELECT substr(geohash_7, 1, 5) AS geohash_5,
  count(DISTINCT geohash_7) AS n_fine_cells, count(*) AS n_rows, count(DISTINCT vehicleId) AS n_vehicles
FROM ({_CITY_GH}) g GROUP BY 1""")
def heatmap_rollup_5(spark, sf):
    return cell_rollup(_encoded(spark, sf, form="city"), "geohash_7", "geohash_5", "vehicleId")


_FLAG_COUNTS = ", ".join(f"count(DISTINCT {f}) AS {f}_count" for f in FLAGS)


@query("cell_flag_distincts", f"""SELECT geohash_7, substr(geohash_7, 1, 5) AS geohash_5, count(*) AS n_rows, {_FLAG_COUNTS}
FROM ({_CITY_GH}) g GROUP BY geohash_7""")
def cell_flag_distincts(spark, sf):
    """Distinct values of each event column per (geohash_7, geohash_5)."""
    return state_counts(cell_state(_encoded(spark, sf, form="city"), ["geohash_7", "geohash_5"], FLAGS))


@query("cell_flag_distincts_5", f"""SELECT substr(geohash_7, 1, 5) AS geohash_5, count(*) AS n_rows, {_FLAG_COUNTS},
  count(DISTINCT vehicleId) AS "vehicleId_count" FROM ({_CITY_GH}) g GROUP BY 1""")
def cell_flag_distincts_5(spark, sf):
    """The fine cells' states rolled up to the coarse cells; vehicles by exact pairs."""
    enc, cells = _encoded(spark, sf, form="city"), ["geohash_7", "geohash_5"]
    flags = state_counts(roll_up(cell_state(enc, cells, FLAGS), "geohash_5"))
    return flags.join(pair_counts(exact_pairs(enc, cells, "vehicleId"), "geohash_5", "vehicleId"), "geohash_5", "left")


@query("sql_cell_counts", f"""SELECT geohash_7, count(*) AS count FROM ({_CITY_GH}) g GROUP BY geohash_7""")
def sql_cell_counts(spark, sf):
    """The reference's SQL per-cell count, over the encoded telemetry as an argument."""
    return spark.sql("SELECT geohash_7, COUNT(*) AS count FROM {cells} GROUP BY geohash_7 ORDER BY count DESC",
                     cells=_encoded(spark, sf, form="city"))


# ---------------------------------------------------------------- T1 / T2 / T3
@query("parse_event_time", f"""SELECT event_id, eventDateTime AS digits,
  try_strptime(eventDateTime, '%Y%m%d%H%M') AS event_time,
  try_strptime(CAST(CAST(eventDateTime AS BIGINT) AS VARCHAR), '%Y%m%d%H%M') AS event_time_from_long
FROM ({sg.telemetry_sql('wide')}) t""")
def parse_event_time_q(spark, sf):
    tel = fx.telemetry(spark, sf, "wide")
    return tel.select("event_id", F.col("eventDateTime").alias("digits"),
                      parse_event_time("eventDateTime").alias("event_time"),
                      parse_event_time(F.col("eventDateTime").cast("long")).alias("event_time_from_long"))


@query("timestamp_text", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
  strftime(ts, '%Y-%m-%d %H:%M') AS ts_minute FROM events""")
def timestamp_text(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select("event_id",
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm").alias("ts_minute"))


@query("event_month", """SELECT strftime(ts, '%B') AS eventMonth, count(*) AS n_events
FROM events GROUP BY 1""")
def event_month(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.groupBy(month_name("ts").alias("eventMonth")).agg(F.count(F.lit(1)).alias("n_events"))


# ---------------------------------------------------------------- G7 / G8
def _case_sql(out="event_type"):
    parts = []
    for f in FLAGS:
        others = " AND ".join(f"{o} = 0" for o in FLAGS if o != f)
        parts.append(f"WHEN {f} > 0 AND {others} THEN '{ev.EVENT_LABELS[f]}'")
    return f"CASE {' '.join(parts)} END AS {out}"


_TEL_WIDE = sg.telemetry_sql("wide")


@query("event_exclusive_class", f"""SELECT event_id, vehicleId, event_type FROM
(SELECT event_id, vehicleId, {_case_sql()} FROM ({_TEL_WIDE}) t) c WHERE event_type IS NOT NULL""")
def event_exclusive_class(spark, sf):
    tel = fx.telemetry(spark, sf, "wide")
    return ev.classify_exclusive(tel).select("event_id", "vehicleId", "event_type")


def _union_sql():
    parts = []
    for f in FLAGS:
        others = " AND ".join(f"{o} = 0" for o in FLAGS if o != f)
        parts.append(f"SELECT event_id, vehicleId, '{ev.EVENT_LABELS[f]}' AS event_type "
                     f"FROM ({_TEL_WIDE}) t WHERE {f} > 0 AND {others}")
    return " UNION ALL ".join(parts)


@query("event_union", _union_sql())
def event_union(spark, sf):
    """Four labelled subsets put together; one pass, as the subsets exclude each other."""
    tel = fx.telemetry(spark, sf, "wide").select("event_id", "vehicleId", *FLAGS)
    return ev.classify_exclusive(tel).select("event_id", "vehicleId", "event_type")


@query("event_distinct_counts", f"""SELECT vehicleId, count(DISTINCT event_type) AS n_event_types,
  count(*) AS n_events FROM (SELECT vehicleId, {_case_sql()} FROM ({_TEL_WIDE}) t) c
WHERE event_type IS NOT NULL GROUP BY vehicleId""")
def event_distinct_counts(spark, sf):
    classified = ev.classify_exclusive(fx.telemetry(spark, sf, "wide"))
    return classified.groupBy("vehicleId").agg(F.countDistinct("event_type").alias("n_event_types"),
                                               F.count(F.lit(1)).alias("n_events"))


# ---------------------------------------------------------------- G10 pipeline and its parts
_PLAT, _PLON = sg.centre_sql("geohash_7", 7, as_float=True)
_PIPE_TEL = sg.telemetry_sql("wide", invalid_every=97)
_PIPE_GH = sg.geohash_sql(_PIPE_TEL, "gpsLatitude", "gpslongitude", 7)
PIPE_ENRICHED_SQL = f"""SELECT g.event_id, g.vehicleId, try_strptime(g.eventDateTime, '%Y%m%d%H%M') AS eventDateTime,
  g.rashturning, g.overspeeding, g.harshacceleration, g.harshbrake,
  g.geohash_7, substr(g.geohash_7, 1, 5) AS geohash_5,
  {_PLAT} AS Latitude, {_PLON} AS Longitude,
  strftime(try_strptime(g.eventDateTime, '%Y%m%d%H%M'), '%B') AS eventMonth,
  a.asset_number, a.lob AS LOB, a.pl AS PL, a.ppl AS PPL, a.Region, a.State, a.City, a.District
FROM ({_PIPE_GH}) g LEFT JOIN ({sg.clean_assets_sql()}) a ON g.vehicleId = a.asset_number"""

_KEYS_SQL = ", ".join(HEATMAP_KEYS)
PIPELINE_SQL = f"""SELECT DISTINCT {_KEYS_SQL},
  CAST(CASE WHEN vehicleId IS NULL THEN 0 ELSE 1 END AS BIGINT) AS VinCount,
  CAST(eventDateTime AS VARCHAR) AS eventdate_1
FROM ({PIPE_ENRICHED_SQL}) e
WHERE Latitude <> -90 AND Latitude <> 90 AND Longitude <> -180 AND Longitude <> 180"""


def _pipeline_enriched(spark, sf, extra=None, valid_only=False):
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    return enrich_telemetry(tel, fx.asset_dimension(spark, sf), extra=extra, valid_only=valid_only)


def _heatmap(spark, sf):
    """G10 output: valid rows filtered on raw coordinates before encoding, and
    deduplicated on the telemetry keys before the asset join."""
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    return heatmap_from_telemetry(tel, fx.asset_dimension(spark, sf))


def _active_totals(spark, sf):
    """Per vehicle, the sum of VinCount over the heatmap table, kept when > 10.

    VinCount is 1 per distinct heatmap key (0 for a NULL vehicle) and the
    asset columns are a function of the vehicle, so the sum is the number of
    distinct telemetry keys per vehicle: dedup (map-side partial) and count,
    no asset join needed.
    """
    from tessera.operators.pipeline import TELEMETRY_KEYS
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    keys = prepare_telemetry(tel, valid_only=True).select(*TELEMETRY_KEYS).dropDuplicates(TELEMETRY_KEYS)
    counted = keys.withColumn("VinCount", F.when(F.col("vehicleId").isNull(), 0).otherwise(1))
    return ev.vehicle_totals(counted, "vehicleId", "VinCount", 10)


def _double_coords(df):
    return (df.withColumn("Latitude", F.round(F.col("Latitude").cast("double"), 2))
              .withColumn("Longitude", F.round(F.col("Longitude").cast("double"), 2)))


@query("heatmap_pipeline", PIPELINE_SQL)
def heatmap_pipeline(spark, sf):
    """Full G10 chain; float centres are shown as doubles rounded to 2 places."""
    return _double_coords(_heatmap(spark, sf))


@query("heatmap_exact_key", f"""SELECT geohash_7, vehicleId, eventDateTime, VinCount FROM ({PIPELINE_SQL}) p""")
def heatmap_exact_key(spark, sf):
    return _heatmap(spark, sf).select("geohash_7", "vehicleId", "eventDateTime", "VinCount")


@query("enrich_left_join", f"""SELECT event_id, vehicleId, asset_number, LOB AS lob, State AS state,
  Region AS region FROM ({PIPE_ENRICHED_SQL}) e""")
def enrich_left_join(spark, sf):
    e = _pipeline_enriched(spark, sf, extra=["event_id"])
    return e.select("event_id", "vehicleId", "asset_number", "lob",
                    F.col("State").alias("state"), F.col("Region").alias("region"))


@query("geo_valid_filter", f"""SELECT event_id, geohash_7 FROM ({PIPE_ENRICHED_SQL}) e
WHERE Latitude <> -90 AND Latitude <> 90 AND Longitude <> -180 AND Longitude <> 180""")
def geo_valid_filter(spark, sf):
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    return prepare_telemetry(tel, extra=["event_id"], valid_only=True).select("event_id", "geohash_7")


@query("dim_clean_dedup", f"""SELECT asset_number, lob, pl, ppl, Region, State, City, District
FROM ({sg.clean_assets_sql()}) a""")
def dim_clean_dedup(spark, sf):
    from tessera.operators.enrich import prepare_assets
    return prepare_assets(fx.asset_dimension(spark, sf))


_VEH_SQL = f"""SELECT vehicleId, CAST(sum(VinCount) AS BIGINT) AS totalVinCount FROM ({PIPELINE_SQL}) p
GROUP BY vehicleId HAVING sum(VinCount) > 10"""


@query("vehicles_active", _VEH_SQL)
def vehicles_active(spark, sf):
    return _active_totals(spark, sf)


@query("events_active_vehicles", f"""SELECT c.vehicleId, c.event_id, c.event_type, v.totalVinCount
FROM (SELECT event_id, vehicleId, {_case_sql()} FROM ({PIPE_ENRICHED_SQL}) e) c
JOIN ({_VEH_SQL}) v ON c.vehicleId = v.vehicleId WHERE c.event_type IS NOT NULL""")
def events_active_vehicles(spark, sf):
    """Classes restricted to active vehicles.  The reference classifies the
    enriched rows; the left join with the deduplicated asset table keeps every
    row once and leaves the flags alone, so classifying the telemetry
    directly gives the same rows without a second join."""
    totals = _active_totals(spark, sf)
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    classified = ev.classify_exclusive(tel).select("event_id", "vehicleId", "event_type")
    return ev.restrict_to_active(classified, totals).select(
        "vehicleId", "event_id", "event_type", "totalVinCount")


@query("inner_join_using", f"""SELECT vehicleId, event_id, totalVinCount FROM ({_TEL_WIDE}) t
JOIN ({_VEH_SQL}) v USING (vehicleId)""")
def inner_join_using(spark, sf):
    totals = _active_totals(spark, sf)
    tel = fx.telemetry(spark, sf, "wide").select("vehicleId", "event_id")
    return tel.join(totals, "vehicleId").select("vehicleId", "event_id", "totalVinCount")


@query("bounding_box", f"""SELECT min(Latitude) AS MinLatitude, max(Latitude) AS MaxLatitude,
  min(Longitude) AS MinLongitude, max(Longitude) AS MaxLongitude FROM ({PIPELINE_SQL}) p""")
def bounding_box_q(spark, sf):
    """Bounding box of the heatmap.  min / max do not change under the
    heatmap's dedup or its row-preserving asset join, so one partial global
    aggregate over the valid, encoded telemetry suffices (no shuffle of rows)."""
    tel = fx.telemetry(spark, sf, "wide", invalid_every=97)
    valid = prepare_telemetry(tel, valid_only=True)
    return bounding_box(_double_coords(valid))


# ---------------------------------------------------------------- G11 / G12 / J4
_PTS_SQL = f"SELECT DISTINCT gpsLatitude AS latitude, gpslongitude AS longitude FROM ({sg.telemetry_sql('city')}) t"


def _nearest_sql():
    dist = ("2 * 6371.0088 * asin(least(sqrt(pow(sin((radians(g.lat) - radians(p.latitude)) / 2), 2) + "
            "cos(radians(p.latitude)) * cos(radians(g.lat)) * "
            "pow(sin((radians(g.lon) - radians(p.longitude)) / 2), 2)), 1.0))")
    return f"""SELECT p.latitude, p.longitude, g.place_id, g.name, g.admin1, g.admin2,
  {dist} AS dist_km FROM ({_PTS_SQL}) p, ({sg.gazetteer_sql()}) g
QUALIFY row_number() OVER (PARTITION BY p.latitude, p.longitude ORDER BY {dist}, g.place_id) = 1"""


@query("reverse_geocode", f"""SELECT latitude, longitude, name AS City_Town, admin1 AS State,
  admin2 AS District, round(dist_km, 3) AS dist_km FROM ({_nearest_sql()}) n""")
def reverse_geocode(spark, sf):
    pts = fx.telemetry(spark, sf, "city").select(F.col("gpsLatitude").alias("latitude"),
                                                 F.col("gpslongitude").alias("longitude")).distinct()
    res = nearest_place(pts, fx.gazetteer(spark, sf), "latitude", "longitude")
    return res.select("latitude", "longitude",
                      F.col("place.name").alias("City_Town"), F.col("place.admin1").alias("State"),
                      F.col("place.admin2").alias("District"),
                      F.round("place.dist_km", 3).alias("dist_km"))


@query("reverse_geocode_address", f"""SELECT t.event_id, n.name || ', ' || n.admin2 || ', ' || n.admin1 AS address
FROM ({sg.telemetry_sql('city')}) t JOIN ({_nearest_sql()}) n
ON t.gpsLatitude = n.latitude AND t.gpslongitude = n.longitude""")
def reverse_geocode_address(spark, sf):
    from tessera.operators.places import with_address
    tel = fx.telemetry(spark, sf, "city").select("event_id", "gpsLatitude", "gpslongitude")
    out = with_address(tel, fx.gazetteer(spark, sf), "gpsLatitude", "gpslongitude")
    return out.select("event_id", "address")


@query("join_back_on_id", f"""SELECT t.event_id, t.vehicleId, t.gpsLatitude, n.name AS city
FROM ({sg.telemetry_sql('city')}) t JOIN ({_nearest_sql()}) n
ON t.gpsLatitude = n.latitude AND t.gpslongitude = n.longitude""")
def join_back_on_id(spark, sf):
    """Look up distinct coordinates once, then attach the result to every row by id."""
    tel = fx.telemetry(spark, sf, "city")
    looked = nearest_place(tel.select("event_id", "gpsLatitude", "gpslongitude"),
                           fx.gazetteer(spark, sf), "gpsLatitude", "gpslongitude")
    derived = looked.select("event_id", F.col("place.name").alias("city"))
    return tel.select("event_id", "vehicleId", "gpsLatitude").join(derived, "event_id")


@query("struct_fields", f"""SELECT latitude, longitude, name AS City_Town, admin1 AS State, admin2 AS District
FROM ({_nearest_sql()}) n""")
def struct_fields(spark, sf):
    """struct(lat, lon) in, struct(name, admin1, admin2) out, then getField into columns."""
    pts = (fx.telemetry(spark, sf, "city")
             .select(F.struct(F.col("gpsLatitude").alias("lat"), F.col("gpslongitude").alias("lon")).alias("pt"))
             .dropDuplicates(["pt"]))
    flat = pts.select(F.col("pt").getField("lat").alias("latitude"), F.col("pt").getField("lon").alias("longitude"))
    res = nearest_place(flat, fx.gazetteer(spark, sf), "latitude", "longitude")
    data = res.withColumn("data", F.struct(F.col("place.name").alias("name"), F.col("place.admin1").alias("admin1"),
                                           F.col("place.admin2").alias("admin2")))
    return (data.withColumn("City_Town", F.col("data").getField("name"))
                .withColumn("State", F.col("data").getField("admin1"))
                .withColumn("District", F.col("data").getField("admin2"))
                .select("latitude", "longitude", "City_Town", "State", "District"))
