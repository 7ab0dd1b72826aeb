"""Geohash table operators.

The column builders in ``tessera.functions.geohash`` give one expression per
cell.  The operators below stage the work in a few projections (axis indices
first, then characters) so every intermediate is computed once per row and
the whole chain stays inside one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import geohash as gh
from tessera.functions.text import coordinate_text


def with_geohash(df: DataFrame, lat: str, lon: str, precision: int = 7,
                 out: str | None = None, prefixes: Sequence[int] = (),
                 centre: tuple[str, str] | None = None, centre_as_float: bool = True) -> DataFrame:
    """Add the geohash cell of (lat, lon); coarser cells are prefixes of it.

    ``prefixes=(5,)`` adds ``geohash_5`` as ``substring(geohash_7, 1, 5)``: a
    coarser geohash is by construction a prefix of a finer one, so the second
    encode of the reference is replaced by a substring.

    ``centre=("Latitude", "Longitude")`` also adds the rounded cell centre
    (what decoding the new cell gives) straight from the interval indices,
    without parsing the string back.
    """
    out = out or f"geohash_{precision}"
    lat_bits, lon_bits = gh.axis_bits(precision)
    t = "__gh_"
    staged = df.withColumns({
        t + "ok": gh.valid_point(lat, lon),
        t + "ky0": gh.raw_index(lat, *gh.LAT_RANGE, lat_bits),
        t + "kx0": gh.raw_index(lon, *gh.LON_RANGE, lon_bits),
    })
    staged = staged.withColumns({
        t + "ky": gh.fix_index(lat, t + "ky0", *gh.LAT_RANGE, lat_bits),
        t + "kx": gh.fix_index(lon, t + "kx0", *gh.LON_RANGE, lon_bits),
    })
    ok = F.col(t + "ok")
    outputs = {out: F.when(ok, gh.chars_from_indices(t + "ky", t + "kx", precision))}
    if centre:
        dlat, dlon = gh.decode_digits(precision)
        typ = "float" if centre_as_float else "double"
        outputs[centre[0]] = F.when(ok, gh.centre(t + "ky", *gh.LAT_RANGE, lat_bits, dlat)).cast(typ)
        outputs[centre[1]] = F.when(ok, gh.centre(t + "kx", *gh.LON_RANGE, lon_bits, dlon)).cast(typ)
    staged = staged.withColumns(outputs)
    prefix_cols = {}
    for p in prefixes:
        if p >= precision:
            raise ValueError(f"prefix precision {p} must be below {precision}")
        prefix_cols[f"geohash_{p}"] = F.substring(out, 1, p)
    if prefix_cols:
        staged = staged.withColumns(prefix_cols)
    return staged.drop(*[c for c in staged.columns if c.startswith(t)])


def with_decoded(df: DataFrame, cell: str, precision: int = 7, lat_out: str = "Latitude",
                 lon_out: str = "Longitude", array_out: str | None = None,
                 as_float: bool = True) -> DataFrame:
    """Add the rounded centre of ``cell``: two columns, optionally the [lat, lon] array too.

    The reference produces ``array<float>`` and splits it into two float
    columns; ``as_float=False`` keeps doubles.
    """
    t = "__ghd_"
    staged = df.withColumn(t + "ok", gh.well_formed(cell, precision))
    klat, klon = gh.indices_from_cell(cell, precision)
    staged = staged.withColumn(t + "ky", klat).withColumn(t + "kx", klon)
    lat_bits, lon_bits = gh.axis_bits(precision)
    dlat, dlon = gh.decode_digits(precision)
    ok = F.col(t + "ok")
    typ = "float" if as_float else "double"
    staged = (staged
              .withColumn(lat_out, F.when(ok, gh.centre(t + "ky", *gh.LAT_RANGE, lat_bits, dlat)).cast(typ))
              .withColumn(lon_out, F.when(ok, gh.centre(t + "kx", *gh.LON_RANGE, lon_bits, dlon)).cast(typ)))
    if array_out:
        staged = staged.withColumn(
            array_out, F.when(F.col(lat_out).isNotNull(), F.array(lat_out, lon_out)))
    return staged.drop(t + "ok", t + "ky", t + "kx")


def with_coordinate_text(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude",
                         out: str = "coordinates", wrap: tuple[str, str] | None = None) -> DataFrame:
    return df.withColumn(out, coordinate_text(lat, lon, wrap=wrap))


def drop_invalid_cells(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude",
                       drop_null_island: bool = False, cell: str | None = None) -> DataFrame:
    """Drop rows whose decoded centre sits on a pole or on the antimeridian.

    Sentinel coordinates land in the corner cells (``zzzzzzz`` decodes to
    (90, 180)); NULL centres are dropped too, as ``!=`` on NULL is not true.
    ``drop_null_island`` also removes the (0, 0) cell ``7zzzzzz`` (needs ``cell``).
    """
    la, lo = F.col(lat), F.col(lon)
    cond = (la != -90) & (la != 90) & (lo != -180) & (lo != 180)
    if drop_null_island:
        if cell is None:
            raise ValueError("drop_null_island needs the cell column")
        # the (0, 0) corner cell is "7" followed by "z" at every precision
        cond = cond & ~F.col(cell).rlike("^7z*$")
    return df.filter(cond)


def _rounded(x: float, digits: int) -> float:
    """Spark's round(): HALF_UP on the shortest decimal form of the double."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def edge_free_range(lo: float, hi: float, bits: int, digits: int) -> tuple[float | None, float | None]:
    """Raw bounds (a, b) with: decoded centre not in {lo, hi}  <=>  a < x <= b.

    Cells whose rounded centre equals an edge value are the first few / last
    few intervals; interval k holds x with lo + k*step < x <= lo + (k+1)*step
    (after clamping), so "k strictly between them" is a half-open range of x.
    ``None`` means no bound on that side.
    """
    step = (hi - lo) / (1 << bits)
    n = 1 << bits
    k_lo = -1
    while k_lo + 1 < n and _rounded(lo + (k_lo + 1 + 0.5) * step, digits) + 0.0 == lo:
        k_lo += 1
    k_hi = n
    while k_hi - 1 >= 0 and _rounded(lo + (k_hi - 1 + 0.5) * step, digits) + 0.0 == hi:
        k_hi -= 1
    a = None if k_lo < 0 else lo + (k_lo + 1) * step
    b = None if k_hi >= n else lo + k_hi * step
    return a, b


def valid_cell_condition(lat: str, lon: str, precision: int = 7):
    """Raw-coordinate form of "decoded centre is not on a pole or the antimeridian".

    Equal to filtering the decoded (rounded) centre against +-90 / +-180, NULL
    and NaN included (NaN sorts above every number in Spark), but it reads
    only the raw columns, so Catalyst can push it into the scan.
    """
    lat_bits, lon_bits = gh.axis_bits(precision)
    dlat, dlon = gh.decode_digits(precision)
    cond = gh.valid_point(lat, lon)
    for c, (lo, hi), bits, digits in ((lat, gh.LAT_RANGE, lat_bits, dlat), (lon, gh.LON_RANGE, lon_bits, dlon)):
        a, b = edge_free_range(lo, hi, bits, digits)
        if a is not None:
            cond = cond & (F.col(c) > F.lit(a))
        if b is not None:
            cond = cond & (F.col(c) <= F.lit(b))
    return cond


def drop_invalid_points(df: DataFrame, lat: str, lon: str, precision: int = 7) -> DataFrame:
    """``drop_invalid_cells`` evaluated on the raw coordinates (see ``valid_cell_condition``)."""
    return df.filter(valid_cell_condition(lat, lon, precision))


def bounding_box(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """One row: MinLatitude, MaxLatitude, MinLongitude, MaxLongitude."""
    return df.agg(F.min(lat).alias("MinLatitude"), F.max(lat).alias("MaxLatitude"),
                  F.min(lon).alias("MinLongitude"), F.max(lon).alias("MaxLongitude"))
