"""Geohash encode / decode as native Spark expressions (no Python UDF).

Cell rule: at every bisection step a value goes to the upper half only when it
is strictly greater than the midpoint (a value on a midpoint stays low).  The
closed form used here picks, per axis, the interval index ``k`` with
``lo + k*step < x <= lo + (k+1)*step`` (``x == lo`` gives 0).  All cell edges
are exact binary fractions, so after a +-1 correction against the edges the
index equals the bisection result bit for bit.

The two axis indices are bit-interleaved (longitude takes the even bit
positions counted from the most significant bit) and the interleaved code is
written in base 32 with the geohash alphabet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard geohash base-32 alphabet and the coordinate ranges.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)


def axis_bits(precision: int) -> tuple[int, int]:
    """(latitude bits, longitude bits) for a geohash of ``precision`` characters."""
    n = 5 * precision
    return n // 2, (n + 1) // 2


def decode_digits(precision: int) -> tuple[int, int]:
    """Decimal digits kept when decoding: max(1, round(-log10(half cell))) - 1 per axis."""
    lat_bits, lon_bits = axis_bits(precision)
    out = []
    for bits, (lo, hi) in ((lat_bits, LAT_RANGE), (lon_bits, LON_RANGE)):
        half = (hi - lo) / 2 ** bits / 2
        out.append(max(1, int(round(-math.log10(half)))) - 1)
    return out[0], out[1]


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_point(lat, lon) -> Column:
    """True when both coordinates are non-NULL and not NaN."""
    lat, lon = _as_col(lat), _as_col(lon)
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def raw_index(x, lo: float, hi: float, bits: int) -> Column:
    """First guess of the interval index; exact up to +-1 (see ``fix_index``)."""
    step = (hi - lo) / (1 << bits)
    xc = F.least(F.greatest(_as_col(x).cast("double"), F.lit(lo)), F.lit(hi))
    return F.ceil((xc - F.lit(lo)) / F.lit(step)) - F.lit(1)


def fix_index(x, k, lo: float, hi: float, bits: int) -> Column:
    """Correct ``k`` against the exact cell edges and clamp to [0, 2^bits - 1]."""
    step = (hi - lo) / (1 << bits)
    x, k = _as_col(x).cast("double"), _as_col(k)
    fixed = (F.when(x <= F.lit(lo) + k * F.lit(step), k - 1)
             .when(x > F.lit(lo) + (k + 1) * F.lit(step), k + 1)
             .otherwise(k))
    return F.least(F.greatest(fixed, F.lit(0)), F.lit((1 << bits) - 1)).cast("long")


def axis_index(x, lo: float, hi: float, bits: int) -> Column:
    return fix_index(x, raw_index(x, lo, hi, bits), lo, hi, bits)


# Spark's conv() writes base-32 digits as 0-9 then A-V; translate() maps them
# onto the geohash alphabet.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# SPREAD8[v]: the 8 bits of v moved to the even bit positions 0, 2, ..., 14.
SPREAD8 = [sum(((v >> b) & 1) << (2 * b) for b in range(8)) for v in range(256)]
# COMPACT8[v]: the bits of v at even positions 0, 2, 4, 6 packed into 4 bits.
COMPACT8 = [sum(((v >> (2 * b)) & 1) << b for b in range(4)) for v in range(256)]


def _spread(k: Column, nbits: int) -> Column:
    table = F.lit(SPREAD8)
    out = None
    for byte in range((nbits + 7) // 8):
        part = F.shiftleft(F.element_at(table, F.shiftright(k, 8 * byte).bitwiseAND(F.lit(255)).cast("int") + 1)
                           .cast("long"), 16 * byte)
        out = part if out is None else out.bitwiseOR(part)
    return out


def _compact(m: Column, nbits: int) -> Column:
    """Inverse of ``_spread``: the even-position bits of ``m`` packed together."""
    table = F.lit(COMPACT8)
    out = None
    for chunk in range((2 * nbits + 7) // 8):
        part = F.shiftleft(F.element_at(table, F.shiftright(m, 8 * chunk).bitwiseAND(F.lit(255)).cast("int") + 1)
                           .cast("long"), 4 * chunk)
        out = part if out is None else out.bitwiseOR(part)
    return out


def _shifts(precision: int) -> tuple[int, int]:
    """(latitude shift, longitude shift) of the interleaved code: the first
    (most significant) bit of a geohash is always a longitude bit."""
    return (1, 0) if (5 * precision) % 2 == 1 else (0, 1)


def chars_from_indices(klat, klon, precision: int) -> Column:
    """Geohash string from the latitude / longitude interval indices.

    The two indices are bit-interleaved with a byte lookup table, and the
    code is written in base 32 by ``conv`` and mapped to the alphabet: a
    handful of expressions instead of one per bit, which keeps generated
    code small.
    """
    klat, klon = _as_col(klat), _as_col(klon)
    lat_bits, lon_bits = axis_bits(precision)
    sy, sx = _shifts(precision)
    code = F.shiftleft(_spread(klat, lat_bits), sy).bitwiseOR(F.shiftleft(_spread(klon, lon_bits), sx))
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    return F.translate(digits, _CONV_DIGITS, ALPHABET)


def _code_from_cell(cell, precision: int) -> Column:
    digits = F.translate(_as_col(cell), ALPHABET, _CONV_DIGITS)
    return F.conv(digits, 32, 10).cast("long")


def geohash_encode(lat, lon, precision: int = 7) -> Column:
    """Geohash cell of (lat, lon); NULL when either coordinate is NULL or NaN."""
    lat_bits, lon_bits = axis_bits(precision)
    klat = axis_index(lat, *LAT_RANGE, lat_bits)
    klon = axis_index(lon, *LON_RANGE, lon_bits)
    return F.when(valid_point(lat, lon), chars_from_indices(klat, klon, precision))


def indices_from_cell(cell, precision: int) -> tuple[Column, Column]:
    """(klat, klon) of a well-formed cell: base-32 code, then de-interleave."""
    lat_bits, lon_bits = axis_bits(precision)
    sy, sx = _shifts(precision)
    code = _code_from_cell(cell, precision)
    return (_compact(F.shiftright(code, sy), lat_bits).bitwiseAND(F.lit((1 << lat_bits) - 1)),
            _compact(F.shiftright(code, sx), lon_bits).bitwiseAND(F.lit((1 << lon_bits) - 1)))


_CELL_PATTERN = "^[" + ALPHABET + "]{%d}$"


def well_formed(cell, precision: int, values: list | None = None) -> Column:
    """Exactly ``precision`` characters, all from the alphabet."""
    return F.coalesce(_as_col(cell).rlike(_CELL_PATTERN % precision), F.lit(False))


def centre(k, lo: float, hi: float, bits: int, digits: int) -> Column:
    """Rounded cell centre; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    step = (hi - lo) / (1 << bits)
    return F.round(F.lit(lo) + (_as_col(k) + F.lit(0.5)) * F.lit(step), digits) + F.lit(0.0)


def geohash_decode(cell, precision: int = 7, digits: tuple[int, int] | None = None) -> Column:
    """Cell centre as ``array<float>`` [lat, lon], rounded like the classic decoder."""
    lat_c, lon_c = geohash_centre(cell, precision, digits)
    return F.when(lat_c.isNotNull(), F.array(lat_c.cast("float"), lon_c.cast("float")))


def geohash_centre(cell, precision: int = 7, digits: tuple[int, int] | None = None) -> tuple[Column, Column]:
    """(latitude, longitude) double columns of the rounded cell centre; NULL for a malformed cell."""
    lat_bits, lon_bits = axis_bits(precision)
    dlat, dlon = digits if digits is not None else decode_digits(precision)
    klat, klon = indices_from_cell(cell, precision)
    ok = well_formed(cell, precision)
    return (F.when(ok, centre(klat, *LAT_RANGE, lat_bits, dlat)),
            F.when(ok, centre(klon, *LON_RANGE, lon_bits, dlon)))
