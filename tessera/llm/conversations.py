"""Conversation structure repair by weighted interval parsing.

A conversation's roles shall read ``(s?(ua)+)?``: nothing, or user/assistant
pairs after at most one system turn.  The repair grammar is in Chomsky normal
form over the places of that pattern, START, SYSTEM, USER, ASSISTANT: a symbol
``(p, q)`` derives the spans of rows that lead from place p to place q, by the
rules (p, q) -> (p, r) (r, q).  A row keeps its role, gets another or is deleted;
an insertion derives the empty span, and every row's cell is closed under
insertions on both sides.  A cell holds the least (cost, audit) of each symbol.

Cells are combined bottom-up by span length.  All splits of a span give the
same cell, because any derivation passes some place at each row boundary; so
one split per span, in the middle, is enough, and spans of 1, 2, 4, ... rows are
joined.  That makes conversations of any length linear work, and lets Spark
parse segments of a long conversation in different tasks and join the segments'
cells afterwards.

Order: rows of a conversation go by turn (nulls first), rows of one turn by role
and then by a digest of the text.  Null roles and texts read as one space.  A
null conversation id is a conversation of its own.  Identical rows are counted
before they are sorted, so copies of one row are one row with a count; only the
first of them is kept.  Empty tables give empty results.  Texts may be very
long: they are hashed in the scan and read again for the repaired rows only.
Other columns are not read, so they cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

# Costs of the edits, and the white space that counts as blank.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"

SEGMENT = 1024  # rows parsed together at most
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The symbols (p, q) that can derive anything, and per symbol its rules as pairs of symbols.
SYMBOLS = [(p, q) for p in range(4) for q in range(4) if q >= p or (p, q) == (ASSISTANT, USER)]
RULES = [[(SYMBOLS.index((p, r)), SYMBOLS.index((r, q))) for r in range(4) if (p, r) in SYMBOLS and (r, q) in SYMBOLS] for p, q in SYMBOLS]

Cell = list  # per symbol None or (cost, audit, places at the joints)


def join(left: Cell, right: Cell, joint: bool = False) -> Cell:
    """The cell of two neighbouring spans; with ``joint`` it notes the place between them."""
    out = []
    for symbol, rules in enumerate(RULES):
        best = None
        for a, b in rules:
            x, y = left[a], right[b]
            if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                between = str(SYMBOLS[a][1]) if joint else ""
                best = min(best or (1 << 62,), (x[0] + y[0], x[1] + y[1], x[2] + between + y[2]))
        out.append(best)
    return out


def join_all(cells: list[Cell], joint: bool = False) -> Cell:
    """Bottom-up by span length: neighbours are joined until one span is left."""
    while len(cells) > 1:
        cells = [join(cells[k], cells[k + 1], joint) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0]


def _cell(entries: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [(*entries[s], "") if s in entries else None for s in SYMBOLS]


def _inserted() -> Cell:
    """The empty span: nothing, or the cheapest insertions from place to place."""
    cell = _cell({(p, p): (0, "") for p in range(4)} | {(p, NEXT[p, r]): (INSERT, "I") for p in range(4) for r in "ua" if (p, r) in NEXT})
    return join(cell, cell)


EMPTY = _inserted()
DELETED = join(join(EMPTY, _cell({(p, p): (DELETE, "D") for p in range(4)})), EMPTY)


def row_cell(initial: str, truncated: bool, free: bool, copies: int) -> Cell:
    """``copies`` equal rows: the first is edited freely (or must go), the others must go."""
    if not free:
        return _deleted(copies)
    extra = TRUNCATED if truncated else 0
    edits = {(p, p): [(DELETE, "D")] for p in range(4)}
    for p in range(4):
        if (p, initial) in NEXT:
            edits.setdefault((p, NEXT[p, initial]), []).append((KEEP + extra, "K"))
        for r in "ua":
            if (p, r) in NEXT:
                edits.setdefault((p, NEXT[p, r]), []).append((REROLE + extra, "R"))
    cell = join(join(EMPTY, _cell({s: min(e) for s, e in edits.items()})), EMPTY)
    return cell if copies == 1 else join(cell, _deleted(copies - 1))


def _deleted(copies: int) -> Cell:
    """``copies`` rows that must go, with insertions around and between them."""
    cell, power = EMPTY, DELETED
    while copies:
        if copies & 1:
            cell = join(cell, power)
        power, copies = join(power, power) if copies > 1 else power, copies >> 1
    return cell


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the contract's damage; dropped rows have no copies.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops, 1 empties, 2 takes the sentence ends, 3 repeats, 4 makes a user turn.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.pmod(F.crc32(key), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long"), F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                       F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _units(rows: DataFrame) -> DataFrame:
    """One light row per different (conversation, turn, role, text), with its faults; no texts."""
    bare = F.rtrim("text", F.lit(BLANKS))
    light = rows.select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), "copies", (bare == "").alias("blank"),
                        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"))
    keys = ["conv_id", "turn", "role", "digest"]
    units = light.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    seen = (units.where("copies > 0 and not blank").groupBy("conv_id", "role", "digest")
            .agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("earliest"), F.count("*").alias("turns"))
            .where("turns > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("earliest.turn").alias("t")))
    met = seen.hint("shuffle_merge")  # texts said at several turns: any number of them
    return (units.join(met, units.conv_id.eqNullSafe(met.c) & (units.role == met.r) & (units.digest == met.d), "left")
            .withColumn("again", met.r.isNotNull() & ~met.t.eqNullSafe(F.col("turn"))).select(*units.columns, "again"))


@dataclass
class _Segment:
    """What is known of consecutive rows of one conversation."""

    cell: Cell
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None  # initials of the first and last row
    last: str | None = None
    low: int | None = None  # first and last turn that is not null, and how many different ones
    high: int | None = None
    turns: int = 0

    def follow(self, other: _Segment) -> None:
        """Add the counts of the rows that come next."""
        self.blank, self.duplicate, self.truncated = self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated
        if other.first is not None:
            between = self.last is not None and self.last + other.first not in ("su", "ua", "au")
            self.illegal += other.illegal + between
            self.first, self.last = other.first if self.first is None else self.first, other.last
        if other.low is not None:
            self.turns += other.turns - (self.high == other.low)
            self.low, self.high = other.low if self.low is None else self.low, other.high


def _segment(turns: list, roles: list, copies: list, blank: list, truncated: list, again: list) -> _Segment:
    """Parse the rows of one segment."""
    out, cells = _Segment(EMPTY), [EMPTY]
    for t, role, n, b, cut, seen in zip(turns, roles, copies, blank, truncated, again, strict=True):
        if not n:
            continue
        free = not b and not seen
        initial = role[:1]
        out.follow(_Segment(EMPTY, n if b else 0, 0 if b else n - free, int(free and cut), (n - 1) * (initial * 2 not in ("su", "ua", "au")),
                            initial, initial, t, t, int(t is not None)))
        cells.append(row_cell(initial, cut, free, n))
    out.cell = join_all(cells)
    return out


_UNIT = ["turn", "role", "digest", "copies", "blank", "truncated", "again"]
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "low", "high", "turns"]


def _segments(units: DataFrame) -> DataFrame:
    """Rows in order, cut into segments within range partitions, each with its cell and its rows' keys."""
    kind = units.schema["conv_id"].dataType
    out = (f"conv_id {kind.simpleString()}, segment long, costs array<long>, audits array<string>, n_{', n_'.join(f'{c} long' for c in _COUNTS)}, "
           "first string, last string, turn array<long>, role array<string>, digest array<binary>, copies array<long>, free array<boolean>")
    fields = [("segment", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), *((f"n_{c}", pa.int64()) for c in _COUNTS),
              ("first", pa.string()), ("last", pa.string()), ("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())),
              ("digest", pa.list_(pa.binary())), ("copies", pa.list_(pa.int64())), ("free", pa.list_(pa.bool_()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, begun, conv, held, made, conv_type = TaskContext.get().partitionId() << 32, False, None, [[] for _ in _UNIT], [], None

        def close() -> None:
            nonlocal number
            if held[0]:
                t, r, d, n, b, cut, seen = ([*h] for h in held)
                s = _segment(t, r, n, b, cut, seen)
                made.append((conv, number, [-1 if x is None else x[0] for x in s.cell], ["" if x is None else x[1] for x in s.cell],
                             *(getattr(s, c) for c in _COUNTS), s.first, s.last, t, r, d, n, [not x and not y for x, y in zip(b, seen, strict=True)]))
                number += 1
                for h in held:
                    h.clear()

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [conv_type, *(t for _, t in fields)], strict=True)],
                                              ["conv_id", *(n for n, _ in fields)])

        for batch in batches:
            conv_type = batch.column(0).type
            for c, *unit in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not begun or c != conv or len(held[0]) >= SEGMENT:
                    close()
                    begun, conv = True, c
                for h, x in zip(held, unit, strict=True):
                    h.append(x)
            if made:
                yield batch_of(made)
                made.clear()
        close()
        if made:
            yield batch_of(made)

    order = ["conv_id", "turn", "role", "digest"]
    return units.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", *_UNIT).mapInArrow(run, out)


def _reports(segments: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit, its segments and the places between them."""
    counts = [f"n_{c}" for c in _COUNTS]
    kind = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "segments", "places"]

    def report(conv, parts: list[tuple[int, _Segment]]) -> tuple:
        whole = _Segment(EMPTY)
        for _, s in parts:
            whole.follow(s)
        cell = join_all([s.cell for _, s in parts], joint=True)
        cost, audit, joints = min(x for x in (cell[SYMBOLS.index((START, START))], cell[SYMBOLS.index((START, ASSISTANT))]) if x)
        end = str(START if not audit.strip("D") else ASSISTANT)
        gaps = 0 if whole.low is None else min(whole.high - whole.low + 1 - whole.turns, (1 << 63) - 1)
        return (conv, gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost, audit, [n for n, _ in parts], f"{START}{joints}{end}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, parts, made, conv_type = False, None, [], [], None

        def batch_of() -> pa.RecordBatch:
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.list_(pa.int64()), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)
            made.clear()
            return out

        for batch in batches:
            conv_type = batch.column(0).type
            for c, number, costs, audits, first, last, *n in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if begun and c != conv:
                    made.append(report(conv, parts))
                    parts = []
                begun, conv = True, c
                cell = [None if cost < 0 else (cost, audit, "") for cost, audit in zip(costs, audits, strict=True)]
                parts.append((number, _Segment(cell, first=first, last=last, **dict(zip(_COUNTS, n, strict=True)))))
            if made:
                yield batch_of()
        if parts:
            made.append(report(conv, parts))
            yield batch_of()

    light = segments.select("conv_id", "segment", "costs", "audits", "first", "last", *counts)
    return light.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(
        run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, segments array<long>, places string")


def _plans(audit: str, place: int, initials: list[str], copies: list[int]) -> list[str]:
    """Per row what it becomes: u and a are inserted turns, K the kept row, U and A the row with a new role."""
    def turn(place: int) -> str:
        return "u" if (place, "u") in NEXT else "a"

    plans, edits = [], iter(audit)
    for initial, n in zip(initials, copies, strict=True):
        made = ""
        while n:
            e = next(edits)
            n -= e != "I"
            if e != "D":
                made += "K" if e == "K" else turn(place) if e == "I" else turn(place).upper()
                place = NEXT[place, initial if e == "K" else turn(place)]
        plans.append(made)
    for _ in edits:  # insertions behind the last row
        plans[-1] += turn(place)
        place = NEXT[place, turn(place)]
    return plans


def _edits(segments: DataFrame, reports: DataFrame) -> DataFrame:
    """One row per row that leaves something: its keys, its plan, its segment and how many rows the segment gave before."""
    chosen = (reports.select(F.explode(F.arrays_zip("segments", F.sequence(F.lit(1), F.size("segments")).alias("nth"))).alias("s"), "places")
              .select(F.col("s.segments").alias("segment"), F.substring("places", F.col("s.nth"), F.lit(2)).alias("span")))
    kind = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "turn", "role", "digest", "plan", "segment", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, number, audits, turns, roles, digests, copies, span in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                p, q = map(int, span)
                at = 0
                for t, r, d, plan in zip(turns, roles, digests, _plans(audits[SYMBOLS.index((p, q))], p, [r[:1] for r in roles], copies), strict=True):
                    if plan:
                        rows.append((conv, t, r, d, plan, number, at))
                        at += len(plan)
            if rows:
                types = [batch.column(0).type, pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return (segments.join(chosen, "segment").select("conv_id", "segment", "audits", "turn", "role", "digest", "copies", "span")
            .mapInArrow(run, f"conv_id {kind}, turn long, role string, digest binary, plan string, segment long, at long"))


def _repaired(rows: DataFrame, edits: DataFrame, by_conversation: bool) -> DataFrame:
    """Edits meet the texts they keep: both in one order, an edit just before the copies of its row."""
    order = ["conv_id", "turn", "role", "digest"]
    texts = rows.where("copies > 0").select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), F.lit(None).cast("string").alias("plan"),
                                            F.lit(None).cast("long").alias("segment"), F.lit(None).cast("long").alias("at"), "text")
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    dealt = both.repartition("conv_id") if by_conversation else both.repartitionByRange(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "segment", "at", "edit", "turn", "role", "text"]
    full = {"u": "user", "a": "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, conv_type = None, None, None
        for batch in batches:
            conv_type, made = batch.column(0).type, []
            for conv, turn, role, digest, plan, segment, at, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if plan is None:  # a text: the first one after its edit is kept, its copies are not
                    if waiting is None or key != (conv, turn, role, digest):
                        continue
                    plan, segment, at = waiting
                    waiting = None
                else:
                    key = (conv, turn, role, digest)
                while plan and waiting is None:
                    e = plan[0]
                    if e not in full and text is None:
                        waiting = (plan, segment, at)
                        break
                    if e in full:
                        made.append((conv, segment, at, "I", turn, full[e], ""))
                    else:
                        made.append((conv, segment, at, "K" if e == "K" else "R", turn, role if e == "K" else full[e.lower()], text))
                    plan, at = plan[1:], at + 1
            if made:
                types = [conv_type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)

    return (dealt.sortWithinPartitions(*order, F.col("plan").isNull()).select(*order, "plan", "segment", "at", "text")
            .mapInArrow(run, f"conv_id {kind}, segment long, at long, edit string, turn long, role string, text string"))


def repair(rows: DataFrame, by_conversation: bool = False) -> tuple[DataFrame, DataFrame]:
    """The report per conversation, and the repaired rows in order of (conv_id, segment, at).

    ``rows`` has conv_id, turn, role, text and copies (0: the row is gone, its conversation is still reported).
    Repaired rows lie in range partitions, so a long conversation is spread over tasks; ``by_conversation`` puts
    each into one partition, in order, for readers that stream through it.
    """
    segments = stored(_segments(_units(rows)), "segments")
    reports = stored(_reports(segments), "repairs")
    return reports.drop("segments", "places"), _repaired(rows, _edits(segments, reports), by_conversation)


def repair_digests(rows: DataFrame) -> DataFrame:
    """The report with the digest of each repaired conversation, ``role:text`` lines hashed as they stream by."""
    reports, repaired = repair(rows, by_conversation=True)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, own, done, conv_type = False, None, None, [], None

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), [conv_type, pa.string()], strict=True)], ["c", "repaired_sha256"])
            done.clear()
            return out

        for batch in batches:
            conv_type = batch.column(0).type
            for c, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not begun or c != conv:
                    if begun:
                        done.append((conv, own.hexdigest()))
                    begun, conv, own = True, c, hashlib.sha256()
                else:
                    own.update(b"\n")
                own.update(f"{role}:{text}".encode())
            if done:
                yield batch_of()
        if begun:
            done.append((conv, own.hexdigest()))
            yield batch_of()

    digests = repaired.select("conv_id", "role", "text").mapInArrow(run, f"c {kind}, repaired_sha256 string")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (reports.join(digests, reports.conv_id.eqNullSafe(digests.c), "left")
            .select(*reports.columns, F.coalesce("repaired_sha256", empty).alias("repaired_sha256")))


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """Damage as in the contract, then repair: the report with digests."""
    return repair_digests(damaged(rows))
