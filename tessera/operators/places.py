"""Nearest-place lookup: reverse geocoding against a gazetteer table.

Replaces a per-row call to a geocoding service by an index over the places, an
adaptive cell tree.  Places and points are unit vectors, so there are neither
poles nor a date line; straight-line distance orders places as distance on the
globe does.

* A cell's list holds every place that can be nearest to some point of the
  cell.  The root is the cube around the globe and lists all places; while a list
  is longer than ``LEAF_PLACES``, its cell is cut into smaller ones, each of
  which keeps what it needs of that list.  All cells of a level are cut at once.
* Let q be the place nearest to a cell's centre c and r the cell's radius.
  Another place p can only win somewhere in the cell if ``|c-p| - |c-q| <= k r``:
  the difference of two distances grows by at most ``k = 2 sin(w / 2)`` per unit
  of way, where w is the angle under which p and q are seen (k is 2 at most, and
  next to nothing for a far group of places).
* A point takes its leaf by an equi-join on the cell and compares the places of
  that one list, as an array expression.  Coordinates are looked up once each;
  where the root's list is short already, each row compares that list at once.

The index depends on the places only.  It is written to the shared scratch
folder, each level once; its size on disk tells Spark whether to broadcast it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geodist import EARTH_RADIUS_KM
from tessera.functions.geohash import valid_point
from tessera.session import scratch_path

PLACE_COLUMNS = ("place_id", "name", "admin1", "admin2")
LEAF_PLACES = 32
MAX_LEVEL = 16  # cells of about 200 m; lists below it are as long as they must be
_SLACK = 1e-9  # of the globe's radius: 6 mm, for rounding
_STEP = 2  # levels per cut: a cell gives 4 x 4 x 4 smaller ones, of which some twenty touch the globe
_ROOT = 0


def _vector(lat, lon) -> dict[str, Column]:
    """The unit vector."""
    phi, lam = F.radians(lat), F.radians(lon)
    return {"__x": F.cos(phi) * F.cos(lam), "__y": F.cos(phi) * F.sin(lam), "__z": F.sin(phi)}


def _cell(level: Column) -> Column:
    """The cell of __x, __y, __z at a level: its level and its place per axis in one number."""
    def axis(c: str) -> Column:
        finest = F.least(F.floor((F.col(c) + 1) * 2.0 ** (MAX_LEVEL - 1)), F.lit(2 ** MAX_LEVEL - 1))
        return F.call_function("shiftrightunsigned", F.greatest(finest, F.lit(0)).cast("long"), (F.lit(MAX_LEVEL) - level).cast("int"))
    return _key(level, axis("__x"), axis("__y"), axis("__z"))


def _key(level: Column, i: Column, j: Column, k: Column) -> Column:
    out = level.cast("long")
    for axis in (i, j, k):
        out = out * F.lit(1 << MAX_LEVEL) + axis
    return out


def _axes(cell: str) -> list[Column]:
    mask = F.lit((1 << MAX_LEVEL) - 1)
    return [F.shiftrightunsigned(F.col(cell), MAX_LEVEL * n).bitwiseAND(mask) for n in (2, 1, 0)]


def _at_levels(df: DataFrame, levels: Sequence[int]) -> DataFrame:
    """The rows once per level, with ``__cell``."""
    return df.withColumn("__level", F.explode(F.array(*map(F.lit, levels)))).withColumn("__cell", _cell(F.col("__level")))


def _parts(cells: DataFrame, level: int) -> DataFrame:
    """__cell, and as __part the smaller cells in it, ``_STEP`` levels down, that touch the globe."""
    n, side = 1 << _STEP, 2.0 ** (1 - level - _STEP)
    offsets = F.array(*(F.array(*map(F.lit, (a, b, c))) for a in range(n) for b in range(n) for c in range(n)))
    parts = cells.select("__cell", F.explode(offsets).alias("__o"))
    axes = [a * n + F.col("__o")[k] for k, a in enumerate(_axes("__cell"))]
    nearest, farthest = F.lit(0.0), F.lit(0.0)
    for axis in axes:
        lo, hi = axis * side - 1, (axis + 1) * side - 1
        nearest += F.pow(F.greatest(lo, -hi, F.lit(0.0)), 2)
        farthest += F.pow(F.greatest(F.abs(lo), F.abs(hi)), 2)
    return parts.where((nearest <= 1 + _SLACK) & (farthest >= 1 - _SLACK)).select("__cell", _key(F.lit(level + _STEP), *axes).alias("__part"))


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(sum((F.pow(x - y, 2) for x, y in zip(a, b, strict=True)), F.lit(0.0)))


def _cut(rows: DataFrame, long: DataFrame, level: int) -> DataFrame:
    """The lists of the parts of the cells in ``long``, from those cells' lists."""
    side = 2.0 ** (1 - level - _STEP)
    radius = side * math.sqrt(3) / 2
    own = [F.col(c) for c in ("__x", "__y", "__z")]
    inside = rows.join(_parts(long, level), "__cell").drop("__cell").withColumnRenamed("__part", "__cell")
    inside = inside.withColumn("__d", _distance(own, [(a + 0.5) * side - 1 for a in _axes("__cell")]))
    first = inside.groupBy("__cell").agg(F.min(F.struct("__d", *own)).alias("__q"))
    clear = F.col("__q.__d") - radius  # the least distance between q and a point of the cell
    between = _distance(own, [F.col(f"__q.{c}") for c in ("__x", "__y", "__z")])
    # sin w <= |p-q| / |x-q| and 2 sin(w / 2) <= sqrt(2) sin w, as long as p is nearer to q than any point of the cell is
    growth = F.when(between < clear, F.least(F.lit(2.0), math.sqrt(2) * between / clear)).otherwise(2.0)
    return (inside.join(first, "__cell").where(F.col("__d") - F.col("__q.__d") <= growth * radius + _SLACK)
            .select(*rows.columns))


def place_index(places: DataFrame, lat: str = "lat", lon: str = "lon", cols: Sequence[str] = PLACE_COLUMNS,
                leaf_places: int = LEAF_PLACES) -> tuple[DataFrame, list[int]]:
    """The index of the places with a valid coordinate: (__cell, __list) rows, and its levels.

    Of places with one coordinate only the one with the smallest ``cols[0]`` can win, so it alone is listed.
    ``leaf_places`` should be 8 or more: where the areas of several places meet, no smaller cell has a shorter list.
    """
    spark = places.sparkSession
    rest = [c for c in cols[1:] if c not in (lat, lon)]
    one = (places.where(valid_point(lat, lon)).groupBy(F.col(lat).cast("double").alias("__lat"), F.col(lon).cast("double").alias("__lon"))
           .agg(F.min(F.struct(F.col(cols[0]), *rest)).alias("__row")).withColumns(_vector("__lat", "__lon")))
    rows, level, leaves = one.withColumn("__cell", F.lit(_ROOT).cast("long")), 0, []
    while True:
        long = rows.groupBy("__cell").agg(F.count("*").alias("n")).where(F.col("n") > leaf_places).select("__cell")
        if level == MAX_LEVEL or long.isEmpty():
            leaves.append(rows)
            break
        leaves.append(rows.join(long, "__cell", "left_anti"))
        parts, path = _cut(rows, long, level), scratch_path(spark, "place-cells")
        parts.write.parquet(path)
        rows, level = spark.read.schema(parts.schema).parquet(path), level + _STEP
    rows = reduce(DataFrame.unionByName, leaves)
    entry = F.struct(F.col(f"__row.{cols[0]}").alias("k"), F.radians("__lat").alias("pr"), F.radians("__lon").alias("pl"),
                     F.cos(F.radians("__lat")).alias("pc"), F.col("__row").alias("row"))
    # sorted by place, so that its place in the list breaks ties as its id does
    lists = rows.groupBy("__cell").agg(F.array_sort(F.collect_list(entry)).alias("__list"))
    path = scratch_path(spark, "place-index")
    lists.write.parquet(path)
    return spark.read.schema(lists.schema).parquet(path), list(range(0, level + 1, _STEP))


def _winner(df: DataFrame, lat: str, lon: str, cols: Sequence[str], out: str) -> DataFrame:
    """``out`` from ``__list``, which then goes; null where there is no list or no valid coordinate."""
    r, lam = F.radians(lat), F.radians(lon)
    kept = [c for c in df.columns if c != "__list"]
    met = df.select("*", r.alias("__r"), lam.alias("__l"), F.cos(r).alias("__c"))

    def h(g):  # grows with the distance; the distance itself is taken for the winner only
        return F.pow(F.sin((g["pr"] - F.col("__r")) / 2), 2) + F.col("__c") * g["pc"] * F.pow(F.sin((g["pl"] - F.col("__l")) / 2), 2)

    best = F.array_min(F.transform("__list", lambda g, i: F.struct(h(g).alias("h"), i.alias("i"))))
    picked = met.select(*kept, "__list", F.when(valid_point(lat, lon), best).alias("__best"))
    winner = F.element_at(F.col("__list"), F.col("__best.i") + 1)["row"]
    dist = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(F.col("__best.h")), F.lit(1.0)))
    place = F.struct(dist.alias("dist_km"), *[winner[c].alias(c) for c in cols])
    return picked.select(*kept, F.when(F.col("__best").isNotNull(), place).alias(out))


def nearest_place(points: DataFrame, places: DataFrame, lat: str, lon: str,
                  cols: Sequence[str] = PLACE_COLUMNS, out: str = "place", leaf_places: int = LEAF_PLACES) -> DataFrame:
    """Add ``out`` = struct(dist_km, place_id, name, admin1, admin2) of the nearest place.

    ``places`` needs ``lat``, ``lon`` and ``cols``.  Ties on distance go to the
    smallest ``place_id``.  Rows with a NULL or NaN coordinate, and all rows
    when there is no place, get NULL.  Places without a valid coordinate are
    never chosen.
    """
    index, levels = place_index(places, cols=cols, leaf_places=leaf_places)
    if levels == [0]:  # the root is the only leaf: one list of at most leaf_places, for every row
        return _winner(points.withColumn("__list", index.select("__list").scalar()), lat, lon, list(cols), out)
    coords = points.select(lat, lon).filter(valid_point(lat, lon)).distinct()
    met = _at_levels(coords.withColumns(_vector(lat, lon)), levels).join(index, "__cell").select(lat, lon, "__list")
    return points.join(_winner(met, lat, lon, list(cols), out), [lat, lon], "left")


def with_address(points: DataFrame, places: DataFrame, lat: str, lon: str, out: str = "address",
                 max_km: float | None = None, **kw) -> DataFrame:
    """Address text "name, admin2, admin1" of the nearest place (NULL beyond ``max_km``)."""
    res = nearest_place(points, places, lat, lon, out="__place", **kw)
    text = F.concat_ws(", ", "__place.name", "__place.admin2", "__place.admin1")
    if max_km is not None:
        text = F.when(F.col("__place.dist_km") <= max_km, text)
    return res.withColumn(out, F.when(F.col("__place").isNotNull(), text)).drop("__place")


def reverse_geocode_struct(points: DataFrame, places: DataFrame, lat: str, lon: str, **kw) -> DataFrame:
    """The flattened form: City_Town, State, District columns."""
    res = nearest_place(points, places, lat, lon, out="__place", **kw)
    return (res.withColumn("City_Town", F.col("__place.name"))
               .withColumn("State", F.col("__place.admin1"))
               .withColumn("District", F.col("__place.admin2"))
               .drop("__place"))
