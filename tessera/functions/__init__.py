"""Column-expression builders (``Column -> Column``), all JVM-side."""

from tessera.functions.geohash import (ALPHABET, geohash_centre, geohash_decode,
                                       geohash_encode, valid_point)
from tessera.functions.text import classify_by_keywords, clean_key, coordinate_text
from tessera.functions.timefmt import month_name, parse_event_time
from tessera.functions.geodist import haversine_km

__all__ = [
    "ALPHABET", "geohash_encode", "geohash_decode", "geohash_centre", "valid_point",
    "classify_by_keywords", "clean_key", "coordinate_text",
    "parse_event_time", "month_name", "haversine_km",
]
