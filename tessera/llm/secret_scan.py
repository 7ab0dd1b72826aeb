"""Secret scan through a trigram index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived (an OR
of ANDs over the literal strings that every match must hold).  The index keeps
postings of the trigrams that some query names; postings are intersected per
clause and candidates verified by the rule's expression.  Rules without
mandatory trigrams (``hex``) scan every text.  Spans are in code points, end
exclusive.  Null text is empty; a row is told by (doc_id, hash of text), so
repeated rows and null ids have one result each.
"""

from __future__ import annotations

from itertools import product
from re import _constants as RC
from re import _parser as RP

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let

# A private key: header, body and END line; without END the lines of base64 after the header (and after its "Name-Part: value" lines).
# Groups are repeated possessively, which java.util.regex does in a loop, so long texts do not overflow the stack.
_HEAD, _END = "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----END [A-Z ]*PRIVATE KEY-----"
_TO_END = r"[^-]*+(?:-{1,4}[^-]++)*+" + _END
_FIELDS = r"(?:\s*\n[A-Z][A-Za-z]*-[A-Za-z]+: [^\r\n]*+)*+"
_LINES = r"(?:[\s\\>\"',#*]*+[A-Za-z0-9+/]{16,}+={0,2})*+(?:\s*\n[>\x20\t]*[A-Za-z0-9+/]+={0,2}(?=[\r\n\"']|$)|[\s\\]*+[A-Za-z0-9+/]++={1,2})?"
PRIVATE = f"{_HEAD}(?:{_TO_END}|{_FIELDS}{_LINES})"

# Kind, expression, condition on a match m.  The first three are the base.
RULES = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]{24,}"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("private", PRIVATE),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]
BASE = ("assign", "access", "hex")
CHUNK, BLOCK = 128, 4096
MIN_VALUE, MIN_ACCESS = 6, 20


def trigram_clauses(pattern: str) -> list[list[str]]:
    """OR of ANDs of lower-case trigrams that a match must contain; [] when none is mandatory."""
    runs: list[set[str]] = []

    def strings(seq) -> set[str] | None:
        """The exact strings of a sequence, or None when it is not a small finite set."""
        out = {""}
        for op, arg in seq:
            if op is RC.LITERAL:
                nxt = {chr(arg).lower()}
            elif op is RC.SUBPATTERN:
                nxt = strings(arg[-1])
            elif op is RC.BRANCH:
                parts = [strings(x) for x in arg[1]]
                nxt = None if None in parts else set().union(*parts)
            elif op is RC.MAX_REPEAT and arg[:2] == (0, 1):
                inner = strings(arg[2])
                nxt = None if inner is None else inner | {""}
            elif op is RC.IN and all(o is RC.LITERAL for o, _ in arg) and len(arg) <= 6:
                nxt = {chr(a).lower() for _, a in arg}
            else:
                nxt = None
            if nxt is None or len(out) * len(nxt) > 64:
                return None
            out = {a + b for a, b in product(out, nxt)}
        return out

    run: list = []
    for node in [*RP.parse(pattern), (None, None)]:
        if node[0] is not None and strings([node]) is not None and strings([*run, node]) is not None:
            run.append(node)
        else:
            runs.append(strings(run) or {""})
            run = []
    best = max(runs, key=lambda r: min(map(len, r)))
    if min(map(len, best)) < 3:
        return []
    return sorted([sorted({s[i:i + 3] for i in range(len(s) - 2)}) for s in best])


def _before(values: Column, zero: Column, merge) -> Column:
    """Per element the fold of all elements before it, in two levels: chunks, then within a chunk.

    An array can't grow in a fold without being copied each time, so the work would be quadratic;
    this way it is CHUNK steps an element and a CHUNK-th of the square.
    """
    n = F.size(values)
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / CHUNK).cast("int") - 1, F.lit(0))), lambda k: F.slice(values, k * CHUNK + 1, F.lit(CHUNK)))

    def within(part: Column, base: Column) -> Column:
        return F.transform(part, lambda _, i: F.aggregate(F.slice(part, F.lit(1), i), base, merge))

    return let(chunks, lambda parts: let(F.transform(parts, lambda x: F.aggregate(x, zero, merge)), lambda totals: F.flatten(
        F.transform(parts, lambda x, k: let(F.aggregate(F.slice(totals, F.lit(1), k), zero, merge), lambda base: within(x, base))))))


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """Array of (start, end, order, kind): gaps between matches give the places."""
    order = [k for k, _ in RULES].index(kind)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else matches
    least = {"assign": MIN_VALUE, "access": MIN_ACCESS}.get(kind, 1)
    parts = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                         F.transform(matches, F.length).alias("len"), F.transform(value, F.length).alias("val"))
    empty = F.expr("cast(array() as array<struct<s:int,e:int,o:int,kind:string>>)")

    def placed(parts: Column) -> Column:
        at = _before(F.transform(parts, lambda p: p["gap"] + F.coalesce(p["len"], F.lit(0))), F.lit(0), lambda x, y: x + y)
        kept = F.filter(F.arrays_zip(parts.alias("p"), at.alias("at")), lambda z: F.coalesce(z["p"]["val"] >= least, F.lit(False)))
        return F.transform(kept, lambda z: F.struct((z["at"] + z["p"]["gap"]).alias("s"), (z["at"] + z["p"]["gap"] + z["p"]["len"]).alias("e"),
                                                    F.lit(order).alias("o"), F.lit(kind).alias("kind")))

    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, hash of text, rules): the postings of each clause, intersected."""
    clauses = [(kind, i, t, len(c)) for kind, p in RULES for i, c in enumerate(trigram_clauses(p)) for t in c]
    wanted = F.array(*(F.lit(t) for t in sorted({c[2] for c in clauses})))
    postings = docs.select("doc_id", F.xxhash64("text").alias("_t"),
                           F.explode(let(F.lower("text"), lambda x: F.filter(wanted, lambda t: F.contains(x, t)))).alias("tri"))
    queries = docs.sparkSession.createDataFrame(clauses, "kind string, clause int, tri string, need int")
    met = (postings.join(F.broadcast(queries), "tri").groupBy("doc_id", "_t", "kind", "clause", "need")
           .agg(F.count_distinct("tri").alias("n")).where("n = need"))
    return met.groupBy("doc_id", "_t").agg(F.collect_set("kind").alias("kinds"))


def secret_scan(docs: DataFrame, whole_row: bool = False) -> DataFrame:
    """With ``whole_row`` also the input row as struct ``row``.  Columns: doc_id, text, found: array of (s, e, o, kind) by start, then rule order."""
    cand = candidates(docs).withColumnsRenamed({"doc_id": "_d", "_t": "_h"})
    row = ["row"] if whole_row else []
    left = docs.select(*(F.expr("struct(*)").alias(x) for x in row), "doc_id", "text", F.xxhash64("text").alias("_t"))
    both = left.join(cand, left.doc_id.eqNullSafe(cand._d) & (left._t == cand._h), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.expr("cast(array() as array<struct<s:int,e:int,o:int,kind:string>>)")
    per_rule = [(F.when(F.array_contains("kinds", kind), _spans(text, kind, p)).otherwise(none) if trigram_clauses(p) else _spans(text, kind, p))
                for kind, p in RULES]
    return both.select(*row, "doc_id", "text", F.sort_array(F.concat(*per_rule)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    said = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
    base = F.filter("found", lambda x: x["o"] < len(BASE))
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE),
                        F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("found")).alias("spans"))


def redact(mark: str = "[SECRET]") -> Column:
    """The text with every span (overlaps joined) replaced by ``mark``."""
    def cut(blocks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, F.floor(b / BLOCK).cast("int") - first + 1), "")
        return F.substring(near, a - first * BLOCK + 1, b - a)

    def cleaned(blocks: Column) -> Column:
        at = _before(F.transform("found", lambda x: x["e"]), F.lit(0), lambda x, y: F.greatest(x, y))
        pieces = F.transform(F.arrays_zip(F.col("found").alias("x"), at.alias("at")), lambda z: F.when(
            z["x"]["s"] >= z["at"], F.concat(cut(blocks, z["at"], z["x"]["s"]), F.lit(mark))).otherwise(""))
        last = F.array_max(F.transform("found", lambda x: x["e"]))
        return F.concat(F.array_join(pieces, ""), cut(blocks, last, F.length("text")))

    # Blocks: a place deep in a text is found without counting characters from its start.
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size("found") > 0, let(blocks, cleaned)).otherwise(F.col("text"))
