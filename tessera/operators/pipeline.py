"""The composed telemetry-to-heatmap pipeline.

read -> project -> geohash (native) -> decode -> parse time -> month ->
enrich (clean + dedup dimension, left join) -> drop invalid cells ->
exact-key heatmap aggregate -> text date.  No Python worker anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.timefmt import month_name, parse_event_time
from tessera.operators.enrich import enrich_left, prepare_assets
from tessera.functions.text import coordinate_text
from tessera.operators.geo import drop_invalid_points, with_geohash
from tessera.operators.heatmap import exact_key_counts
from tessera.sources.readers import read_partition_range
from tessera.sources.sinks import external_table, write_parquet

# Telemetry columns kept by the reference, and its heatmap key.
TELEMETRY_COLUMNS = ["vehicleId", "eventDateTime", "gpsLatitude", "gpslongitude",
                     "rashturning", "overspeeding", "harshacceleration", "harshbrake"]
HEATMAP_KEYS = ["geohash_7", "geohash_5", "vehicleId", "Latitude", "Longitude", "eventMonth",
                "eventDateTime", "LOB", "PL", "PPL", "Region", "State", "City", "District",
                "rashturning", "overspeeding", "harshacceleration", "harshbrake"]


def prepare_telemetry(tel: DataFrame, extra: list[str] | None = None, valid_only: bool = False) -> DataFrame:
    """Project, encode (7 and its 5-prefix), decode the 7-cell centre, parse time, month, text.

    ``valid_only`` drops rows whose decoded centre is on a pole or the
    antimeridian *before* encoding, with the equivalent raw-coordinate range
    test: the filter then sits on the scan (pushable into parquet) instead of
    being pushed down through the geohash projections.
    """
    df = tel.select(*(extra or []), *TELEMETRY_COLUMNS)
    if valid_only:
        df = drop_invalid_points(df, "gpsLatitude", "gpslongitude", 7)
    df = with_geohash(df, "gpsLatitude", "gpslongitude", 7, prefixes=(5,),
                      centre=("Latitude", "Longitude"))
    df = df.withColumns({"eventDateTime": parse_event_time("eventDateTime"),
                         "coordinates": coordinate_text("Latitude", "Longitude")})
    return df.withColumn("eventMonth", month_name("eventDateTime"))


def enrich_telemetry(tel: DataFrame, assets: DataFrame, extra: list[str] | None = None,
                     valid_only: bool = False) -> DataFrame:
    """Prepared telemetry left-joined with the cleaned, deduplicated asset dimension."""
    return enrich_left(prepare_telemetry(tel, extra, valid_only), prepare_assets(assets),
                       "vehicleId", "asset_number")


def heatmap_table(enriched: DataFrame, already_valid: bool = False) -> DataFrame:
    """Valid cells only, one row per heatmap key, VinCount and the text date.

    Pass an input enriched with ``valid_only=True`` and ``already_valid=True``
    so the validity filter runs before encoding (see ``prepare_telemetry``).
    """
    # same rows as drop_invalid_cells(enriched, "Latitude", "Longitude"), but
    # on the raw coordinates
    valid = enriched if already_valid else drop_invalid_points(enriched, "gpsLatitude", "gpslongitude", 7)
    keyed = valid.select(*[F.col(ASSET_KEYS.get(c, c)).alias(c) for c in HEATMAP_KEYS])
    out = exact_key_counts(keyed, HEATMAP_KEYS, "vehicleId", "VinCount")
    return out.withColumn("eventdate_1", F.col("eventDateTime").cast("string"))


# Heatmap keys that come from the asset; the rest come from the telemetry itself.
ASSET_KEYS = {"LOB": "lob", "PL": "pl", "PPL": "ppl", "Region": "Region", "State": "State", "City": "City", "District": "District"}
TELEMETRY_KEYS = [k for k in HEATMAP_KEYS if k not in ASSET_KEYS]


def heatmap_from_telemetry(tel: DataFrame, assets: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Same rows as ``heatmap_table(enrich_telemetry(tel, assets, valid_only=True), True)``,
    with the deduplication moved before the join.

    After ``prepare_assets`` there is at most one asset row per key, so the
    asset columns are a function of ``vehicleId`` and deduplicating on the
    telemetry keys first loses nothing; the join then sees one row per
    distinct telemetry key instead of every event (map-side partial dedup,
    then a smaller join input).  ``extra`` telemetry columns join the key.
    """
    distinct = prepare_telemetry(tel, list(extra), valid_only=True).select(*TELEMETRY_KEYS, *extra).distinct()
    joined = enrich_left(distinct, prepare_assets(assets), "vehicleId", "asset_number")
    keyed = joined.select(*[F.col(ASSET_KEYS.get(c, c)).alias(c) for c in HEATMAP_KEYS], *extra)
    return (keyed.withColumn("VinCount", F.when(F.col("vehicleId").isNull(), 0).otherwise(1).cast("long"))
                 .withColumn("eventdate_1", F.col("eventDateTime").cast("string")))


def heatmap_job(spark: SparkSession, source: str, start: str, end: str, assets: DataFrame, path: str, table: str,
                column: str = "eventdate") -> DataFrame:
    """From a range of daily telemetry partitions to the external table ``table`` over ``path``; returns the table.

    Only the days of the range are read, and only the days that are written are
    replaced (dynamic partition overwrite), so a job run again leaves the same
    table and other days alone.  A day of the range without any valid row keeps
    what the table held for it.
    """
    days = read_partition_range(spark, source, column, start, end)
    write_parquet(heatmap_from_telemetry(days, assets, (column,)), path, mode="overwrite", partition_by=[column], dynamic=True)
    return external_table(spark, table, path)
