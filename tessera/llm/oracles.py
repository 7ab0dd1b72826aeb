"""DuckDB SQL of the queries that SQL can express, on whole tables.

Each is written from the query's contract, not from the operator: a recursive
sum over bytes gives crc32, a recursion over turns with the four places of the
role pattern gives the repairs, all 50-byte strings give the repeats.
"""

from __future__ import annotations

#: crc32's table of 256 numbers as one list ``t``, by eight halvings of each byte.
CRC_TABLE = """crc(k, x, n) AS (SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT k, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n + 1 FROM crc WHERE n < 8),
crc_table AS (SELECT list(x ORDER BY k) AS t FROM crc WHERE n = 8)"""


def _crc32(text: str) -> str:
    """The checksum of a text's UTF-8 bytes; ``t`` is the table."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"""


# ------------------------------------------------------------------ conversations
def _after(state: str, cost: str | int, letter: str, line: str | None = None) -> str:
    """A state {c: cost, a: audit, l: lines} after one more edit."""
    said = f"list_append({state}.l, {line})" if line else f"{state}.l"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {said}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_CUT, _FREE = "(fault = 'truncated')::BIGINT", "fault NOT IN ('blank', 'duplicate')"


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN {_FREE} AND substr(role, 1, 1) = '{initial}' THEN {_after(state, _CUT, 'K', "role || ':' || text")} END"


def _rerole(state: str, role: str) -> str:
    return f"CASE WHEN {_FREE} THEN {_after(state, f'2 + {_CUT}', 'R', f"'{role}:' || text")} END"


# s0 to s3: best states at the start, after system, after user, after assistant; n0 to n3 before insertions.
_INTO_USER = [_kept(s, "u") for s in ("s0", "s1", "s3")] + [_rerole(s, "user") for s in ("s0", "s1", "s3")]
_INSERT_USER = [_after(n, 2, "I", "'user:'") for n in ("n0", "n1", "n3")]

CONVERSATIONS = f"""
WITH RECURSIVE {CRC_TABLE},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
marked AS (SELECT *, {_crc32('key')} % 20 AS harm FROM keyed, crc_table),
harmed AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, range(CASE WHEN harm = 3 THEN 2 ELSE 1 END) WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM harmed),
judged AS (SELECT *, CASE WHEN core = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || substr(role, 1, 1) AS pair
  FROM (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM placed)),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM judged GROUP BY conv_id),
states(conv_id, pos, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}}, NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]),
    {{'c': 2::BIGINT, 'a': 'I', 'l': ['user:']}}, {{'c': 4::BIGINT, 'a': 'II', 'l': ['user:', 'assistant:']}} FROM counts
  UNION ALL
  SELECT conv_id, pos, n0, n1, c2, {_least('n3', _after('c2', 2, 'I', "'assistant:'"))} FROM (
    SELECT *, {_least('n2', *_INSERT_USER)} AS c2 FROM (
      SELECT s.conv_id, j.pos, {_after('s0', 3, 'D')} AS n0, {_least(_after('s1', 3, 'D'), _kept('s0', 's'))} AS n1,
        {_least(_after('s2', 3, 'D'), *_INTO_USER)} AS n2,
        {_least(_after('s3', 3, 'D'), _kept('s2', 'a'), _rerole('s2', 'assistant'))} AS n3
      FROM states s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = s.pos + 1))),
ended AS (SELECT c.*, {_least('s0', 's3')} AS best FROM counts c JOIN states s ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.pos = c.n)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id"""


# ------------------------------------------------------------------ resampling
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

RESAMPLING = f"""
WITH RECURSIVE {CRC_TABLE},
words AS (SELECT 's' AS side, doc_id, unnest({_WORDS}) AS w FROM documents
  UNION ALL SELECT 't', NULL, unnest({_WORDS}) FROM benchmark),
buckets AS (SELECT w, {_crc32('w')} % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), crc_table),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 's') AS s, count(*) FILTER (WHERE side = 't') AS t FROM words JOIN buckets USING (w) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts),
weights AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id),
scores AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scores s LEFT JOIN drawn d ON s.doc_id = d.doc_id"""


# ------------------------------------------------------------------ archives
_PAYLOAD = "coalesce(html, '')"


def _nibble(at: int) -> str:
    return f"(strpos('0123456789abcdef', substr(h, {at + 1}, 1)) - 1)"


def _base32(k: int) -> str:
    """Digit k of the base-32 form of 160 bits in hex: five bits out of two hex digits (the last fits in both)."""
    first = min(5 * k // 4, 38)
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((({_nibble(first)} * 16 + {_nibble(first + 1)}) >> {3 - 5 * k + 4 * first}) & 31), 1)"


WARC = f"""
SELECT page_id, payload_bytes, {" || ".join(map(_base32, range(32)))} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, octet_length(encode({_PAYLOAD}))::BIGINT AS payload_bytes, sha1({_PAYLOAD}) AS h,
  min(page_id) OVER (PARTITION BY {_PAYLOAD}) AS first FROM pages)"""


# ------------------------------------------------------------------ repeated bytes
# Texts are cut into overlapping chunks first, because substr counts from a string's start each time.
SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
chunks AS (SELECT doc_id, k, substr(h, 1000 * k + 1, 1098) AS x FROM (SELECT doc_id, h, unnest(range(n // 500 + 1)) AS k FROM texts)),
places AS (SELECT doc_id, k, x, unnest(range(least(500, length(x) // 2 - 49))) AS i FROM chunks),
hashed AS (SELECT doc_id, 500 * k + i AS pos, substr(x, 2 * i + 1, 100) AS s, hash(substr(x, 2 * i + 1, 100)) AS z FROM places),
likely AS (SELECT z FROM hashed GROUP BY z HAVING min(doc_id) <> max(doc_id)),
strings AS (SELECT doc_id, pos, s FROM hashed SEMI JOIN likely USING (z)),
shared AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, pos, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS step FROM strings JOIN shared USING (s) WHERE doc_id > first),
runs AS (SELECT doc_id, pos, count(*) FILTER (WHERE step > 50 OR step IS NULL) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM hits),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b, lag(max(pos) + 50, 1, 0) OVER (PARTITION BY doc_id ORDER BY min(pos)) AS before
  FROM runs GROUP BY doc_id, run),
left_over AS (SELECT t.doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM spans JOIN texts t USING (doc_id) GROUP BY t.doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)"""
