"""Nearest place by the cell tree against comparing every point with every place."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.functions.geodist import haversine_km
from tessera.operators.places import nearest_place, place_index
from tessera.plans import fixtures as fx

PLACES = "place_id long, name string, admin1 string, admin2 string, lat double, lon double"


def brute(points, places, lat="lat_p", lon="lon_p"):
    """Every point with every place, by the same distance."""
    pairs = points.select(lat, lon).distinct().crossJoin(places)
    d = F.round(haversine_km(F.col(lat), F.col(lon), F.col("lat"), F.col("lon")), 6)
    best = pairs.groupBy(lat, lon).agg(F.min(F.struct(d.alias("d"), "place_id")).alias("b"))
    return {(r[0], r[1]): (r[2], r[3]) for r in best.select(lat, lon, "b.d", "b.place_id").collect()}


def check(spark, points, places, **kw):
    pts = spark.createDataFrame(points, "lat_p double, lon_p double")
    pl = spark.createDataFrame(places, PLACES)
    want = brute(pts, pl)
    got = nearest_place(pts, pl, "lat_p", "lon_p", **kw).select("lat_p", "lon_p", "place.dist_km", "place.place_id").collect()
    assert len(got) == len(points)
    dist = {p[0]: (p[4], p[5]) for p in places}
    for la, lo, d, k in got:
        assert abs(d - want[la, lo][0]) < 2e-6, (la, lo, d, k, want[la, lo], dist[k])


def town(k, n, lat, lon, spread, r):
    return [(k + i, f"p{k + i}", "s", "d", lat + r.gauss(0, spread), lon + r.gauss(0, spread)) for i in range(n)]


def test_one_city_of_5000_places(spark):
    r = random.Random(3)
    places = town(0, 5000, 48.2, 16.37, 0.05, r)
    near = [(48.2 + r.gauss(0, 0.08), 16.37 + r.gauss(0, 0.08)) for _ in range(400)]
    far = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(60)] + [(-48.2, -163.63), (90.0, 0.0), (-90.0, 7.0)]
    check(spark, near + far, places)


def test_lists_stay_short(spark):
    r = random.Random(4)
    places = spark.createDataFrame(town(0, 1500, 48.2, 16.37, 0.05, r) + [(9000 + i, "x", "s", "d", r.uniform(-80, 80), r.uniform(-180, 180)) for i in range(500)], PLACES)
    index, levels = place_index(places)
    assert levels == list(range(0, max(levels) + 1, 2)) and max(levels) <= 16
    assert index.agg(F.max(F.size("__list"))).first()[0] <= 32


@pytest.mark.parametrize("leaf_places", [8, 32])
def test_globe_poles_and_date_line(spark, leaf_places):
    r = random.Random(leaf_places)
    places = [(i, f"p{i}", "s", "d", math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for i in range(150)]
    places += [(1000, "n", "s", "d", 90.0, 0.0), (1001, "s", "s", "d", -89.99, 12.0), (1002, "w", "s", "d", 0.0, 179.99), (1003, "e", "s", "d", 0.0, -179.99)]
    points = [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(300)]
    points += [(89.9, 170.0), (-90.0, 0.0), (0.1, 180.0), (0.1, -180.0), (0.0, 0.0)] + [(p[4], p[5]) for p in places[:20]]
    check(spark, points, places, leaf_places=leaf_places)


def test_two_far_groups_and_equal_coordinates(spark):
    r = random.Random(9)
    places = town(0, 40, -33.9, 18.4, 0.01, r) + town(100, 40, 64.1, -21.9, 0.01, r) + [(500 + i, "same", "s", "d", 10.0, 10.0) for i in range(200)]
    points = [(10.0, 10.0), (10.1, 10.0), (0.0, 0.0)] + [(r.uniform(-60, 70), r.uniform(-40, 40)) for _ in range(60)]
    check(spark, points, places, leaf_places=16)
    pts, pl = spark.createDataFrame([(10.0, 10.0)], "lat_p double, lon_p double"), spark.createDataFrame(places, PLACES)
    assert nearest_place(pts, pl, "lat_p", "lon_p").first().place.place_id == 500  # of equal places the smallest id


def test_missing_coordinates_and_empty_tables(spark):
    pts = spark.createDataFrame([(1, 10.0, 10.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 10.0, 10.0)], "k int, lat_p double, lon_p double")
    places = spark.createDataFrame([(1, "none", "", "", None, 10.0), (2, "nan", "", "", float("nan"), 10.0), (3, "near", "", "", 11.0, 10.0)], PLACES)
    got = {r.k: r.place and r.place.name for r in nearest_place(pts, places, "lat_p", "lon_p").collect()}
    assert got == {1: "near", 2: None, 3: None, 4: "near"}
    assert {r.place for r in nearest_place(pts, places.limit(0), "lat_p", "lon_p").collect()} == {None}
    assert nearest_place(pts.limit(0), places, "lat_p", "lon_p").count() == 0


def test_fixture_points(spark):
    pts = fx.telemetry(spark, SF_SMALL, "wide").select(F.col("gpsLatitude").alias("lat_p"), F.col("gpslongitude").alias("lon_p"))
    places = fx.gazetteer(spark, SF_SMALL)
    want = brute(pts, places)
    got = nearest_place(pts, places, "lat_p", "lon_p", leaf_places=6).select("lat_p", "lon_p", "place.place_id").distinct().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {k: v[1] for k, v in want.items()}
