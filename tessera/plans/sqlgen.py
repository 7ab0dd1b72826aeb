"""DuckDB SQL text for the oracles: derivations and geohash expressions.

These strings mirror ``tessera.plans.fixtures`` and ``tessera.functions.geohash``
for the side-by-side check; they are specifications, not an execution path.
"""

from __future__ import annotations

from tessera.functions.geohash import (ALPHABET, LAT_RANGE, LON_RANGE, axis_bits,
                                       decode_digits)

_FORMS = {
    "wide": (8.0, 68.0, 290000, 10000.0),
    "city": (18.5, 73.8, 40000, 1000000.0),
}


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def telemetry_sql(form: str = "city", invalid_every: int | None = None) -> str:
    lat0, lon0, mod, div = _FORMS[form]
    lat = f"{d(lat0)} + ((user_id*7919 + event_id*104729) % {mod}) / {d(div)}"
    lon = f"{d(lon0)} + ((user_id*15485863 + event_id*611953) % {mod}) / {d(div)}"
    if invalid_every:
        lat = f"CASE WHEN event_id % {invalid_every} = 0 THEN {d(90.0)} ELSE {lat} END"
        lon = f"CASE WHEN event_id % {invalid_every} = 0 THEN {d(180.0)} ELSE {lon} END"

    def flag(m):
        return f"CASE WHEN event_id % {m} = 0 THEN 1 ELSE 0 END"
    return f"""SELECT event_id,
  CAST(user_id + 1400 AS VARCHAR) AS vehicleId,
  strftime(ts, '%Y%m%d%H%M') AS eventDateTime,
  {lat} AS gpsLatitude,
  {lon} AS gpslongitude,
  {flag(5)} AS rashturning,
  {flag(17)} AS idling,
  {flag(7)} AS overspeeding,
  {flag(11)} AS harshacceleration,
  {flag(13)} AS harshbrake
FROM events"""


def _index_sql(x: str, lo: float, hi: float, bits: int) -> tuple[str, str]:
    step = (hi - lo) / (1 << bits)
    xc = f"least(greatest(CAST({x} AS DOUBLE), {d(lo)}), {d(hi)})"
    k0 = f"(CAST(ceil(({xc} - {d(lo)}) / {d(step)}) AS BIGINT) - 1)"
    return xc, k0


def geohash_sql(src: str, lat: str, lon: str, precision: int = 7, out: str | None = None) -> str:
    """SELECT * plus the geohash of (lat, lon) over the relation ``src``."""
    out = out or f"geohash_{precision}"
    lat_bits, lon_bits = axis_bits(precision)
    ylat, ky0 = _index_sql(lat, *LAT_RANGE, lat_bits)
    xlon, kx0 = _index_sql(lon, *LON_RANGE, lon_bits)

    def fixed(xc, k, lo, hi, bits):
        step = (hi - lo) / (1 << bits)
        f = (f"CASE WHEN {xc} <= {d(lo)} + {k}*{d(step)} THEN {k}-1 "
             f"WHEN {xc} > {d(lo)} + ({k}+1)*{d(step)} THEN {k}+1 ELSE {k} END")
        return f"least(greatest({f}, 0), {(1 << bits) - 1})"
    ok = (f"({lat} IS NOT NULL AND {lon} IS NOT NULL AND NOT isnan(CAST({lat} AS DOUBLE)) "
          f"AND NOT isnan(CAST({lon} AS DOUBLE)))")
    chars = []
    for c in range(precision):
        terms = []
        for j in range(5):
            i = 5 * c + j
            src_k, nb = ("__kx", lon_bits) if i % 2 == 0 else ("__ky", lat_bits)
            terms.append(f"(((({src_k}) >> {nb - 1 - i // 2}) & 1) << {4 - j})")
        chars.append(f"substr('{ALPHABET}', CAST({' + '.join(terms)} AS INTEGER) + 1, 1)")
    s1 = f"SELECT *, {ky0} AS __ky0, {kx0} AS __kx0 FROM ({src}) __s0"
    s2 = (f"SELECT *, {fixed(ylat, '__ky0', *LAT_RANGE, lat_bits)} AS __ky, "
          f"{fixed(xlon, '__kx0', *LON_RANGE, lon_bits)} AS __kx FROM ({s1}) __s1")
    s3 = (f"SELECT * EXCLUDE (__ky0, __kx0, __ky, __kx), "
          f"CASE WHEN {ok} THEN {' || '.join(chars)} END AS {out} FROM ({s2}) __s2")
    return s3


def centre_sql(cell: str, precision: int = 7, as_float: bool = False) -> tuple[str, str]:
    """(lat, lon) SQL of the rounded centre of ``cell``."""
    lat_bits, lon_bits = axis_bits(precision)
    dlat, dlon = decode_digits(precision)
    vals = [f"(instr('{ALPHABET}', substr({cell}, {c + 1}, 1)) - 1)" for c in range(precision)]
    klat, klon = [], []
    for i in range(5 * precision):
        bit = f"((CAST({vals[i // 5]} AS BIGINT) >> {4 - i % 5}) & 1)"
        if i % 2 == 0:
            klon.append(f"({bit} << {lon_bits - 1 - i // 2})")
        else:
            klat.append(f"({bit} << {lat_bits - 1 - i // 2})")
    ok = f"length({cell}) = {precision} AND " + " AND ".join(f"{v} >= 0" for v in vals)

    def c(ks, lo, hi, bits, digits):
        step = (hi - lo) / (1 << bits)
        e = f"round({d(lo)} + (({' + '.join(ks)}) + 0.5) * {d(step)}, {digits}) + {d(0.0)}"
        e = f"CASE WHEN {ok} THEN {e} END"
        if as_float:
            e = f"round(CAST(CAST({e} AS FLOAT) AS DOUBLE), {digits})"
        return e
    return c(klat, *LAT_RANGE, lat_bits, dlat), c(klon, *LON_RANGE, lon_bits, dlon)


def assets_sql(dirty: bool = True) -> str:
    base = """SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey, c_mktsegment AS lob, c_name AS pl,
  'PPL-' || CAST(c_custkey % 40 AS VARCHAR) AS ppl, r_name AS dlr_region, n_name AS dlr_state,
  'City-' || CAST(c_custkey % 97 AS VARCHAR) AS dlr_org_city,
  'District-' || CAST(c_custkey % 31 AS VARCHAR) AS dlr_district
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
    cols = "lob, pl, ppl, dlr_region, dlr_state, dlr_org_city, dlr_district"
    if not dirty:
        return f"SELECT key AS asset_number, {cols} FROM ({base}) b"
    return (f"SELECT chr(9) || key || chr(9) AS asset_number, {cols} FROM ({base}) b "
            f"UNION ALL SELECT key AS asset_number, lob, lower(pl) AS pl, ppl, dlr_region, dlr_state, "
            f"dlr_org_city, dlr_district FROM ({base}) b WHERE c_custkey % 3 = 0")


def clean_assets_sql() -> str:
    """Rename, clean keys, then keep the smallest row per key."""
    clean = (f"SELECT regexp_replace(asset_number, '^\\s+|\\s+$', '', 'g') AS asset_number, lob, pl, ppl, "
             f"dlr_region AS Region, dlr_state AS State, dlr_org_city AS City, dlr_district AS District "
             f"FROM ({assets_sql(True)}) a")
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY asset_number "
            f"ORDER BY lob, pl, ppl, Region, State, City, District) AS __rn FROM ({clean}) c) WHERE __rn = 1")


def gazetteer_sql() -> str:
    return f"""SELECT CAST(n_nationkey AS BIGINT) AS place_id, n_name AS name, r_name AS admin1,
  'D' || CAST(n_nationkey AS VARCHAR) AS admin2,
  {d(8.0)} + ((n_nationkey * 7907) % 290) / {d(10.0)} AS lat,
  {d(68.0)} + ((n_nationkey * 6133) % 290) / {d(10.0)} AS lon
FROM nation JOIN region ON n_regionkey = r_regionkey"""


PHONE_SQL = """SELECT p_partkey AS id, p_brand AS mobile, p_size AS age, p_retailprice AS ratings,
  CAST(p_partkey % 20 AS DOUBLE) AS experience FROM part"""

BESTSELLERS_SQL = """SELECT p_partkey AS rank, p_name AS title, p_brand AS author, p_retailprice AS price,
  p_type AS publisher, p_size AS published_date FROM part"""

PLAYERS_SQL = """SELECT 'p' || CAST(event_id AS VARCHAR) AS name,
  CAST(trunc(value * 100) AS INTEGER) AS Rating, event_type AS Country FROM events"""

PEOPLE_SQL = """SELECT
  CASE WHEN l_linenumber <> 4 THEN 'n' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS Name,
  CASE WHEN l_linenumber NOT IN (2, 4) THEN CAST(trunc(l_quantity) AS INTEGER) END AS age,
  CASE WHEN l_linenumber NOT IN (3, 4) THEN CAST(l_orderkey % 25 AS INTEGER) END AS Experience,
  CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS Salary
FROM lineitem"""
