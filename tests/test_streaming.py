"""Row-wise operators accept a streaming DataFrame unchanged."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators.events import classify_exclusive
from tessera.operators.geo import with_geohash
from tessera.plans import fixtures as fx
from tessera.session import scratch_path


def test_geohash_and_classes_on_a_stream(spark):
    batch = fx.telemetry(spark, SF_SMALL, "city")
    path = scratch_path(spark, "tel-stream-src")
    batch.write.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    out = classify_exclusive(with_geohash(stream, "gpsLatitude", "gpslongitude", 7))
    q = (out.select("event_id", "geohash_7", "event_type").writeStream.format("memory")
            .queryName("tel_stream_out").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("tel_stream_out")
    want = classify_exclusive(with_geohash(batch, "gpsLatitude", "gpslongitude", 7)).select(
        "event_id", "geohash_7", "event_type")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.filter(F.col("geohash_7").isNull()).count() == 0
