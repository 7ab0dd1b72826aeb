"""Hierarchical packing into windows of several lengths.

Documents become whole windows of the longest tier and one remainder each.
Remainders are routed to the smallest tier that holds them; each tier opens its
windows with its own remainders, and what is left free is filled with
remainders of shorter tiers, the longest that fits first.  Gaps that no
remainder fits are laid end to end and filled by a few remainders laid end to
end and cut at the gaps' ends.  A tier opens only as many windows as the tokens
left can fill, so every window is full: no padding is left, and the last few
tokens make windows of smaller powers of two.

The plan works on the histogram of lengths, at most one row per length of the
longest tier, not on documents.  Only whole remainders split its runs, so it
has some thousands of rows at any size of the corpus (the cut ones are found by
arithmetic) and is broadcast.  Remainders take their places by their rank within
their length; ranks are counted per (length, run of rows), so a length may hold
any share of the rows.

Windows of a tier are dealt evenly over the training steps, so each step holds
the same mix of tiers, up to one window of each.

Null and empty texts hold the end id alone.  Repeated rows get places of their
own; ties take any order.  Very long texts are encoded one after another and
written window by window.  An empty table gives an empty result.  Only doc_id
and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.tokens import worker_encoder

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 1 << 20
ROWS_BITS = 20  # rows ranked together: 2**20 of one length at most
TEXT_BYTES = 1 << 20  # texts encoded together
_LIGHT = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step long"


def _groups(texts: list, limit: int = TEXT_BYTES) -> Iterator[slice]:
    """Slices of about ``limit`` characters; a longer text ends its slice."""
    first, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield slice(first, k + 1)
            first, held = k + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def remainders(docs: DataFrame, tokenizer: str, size: int, end_id: int, by_word: bool = True) -> DataFrame:
    """Whole windows with their checksum, and each document's remainder with its ids (2 or 4 bytes each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = worker_encoder(tokenizer, by_word), np.array([end_id], "<u4")
        names = [c.split()[0] for c in _LIGHT.split(", ")]
        for batch in batches:
            docs_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in _groups(texts):
                rows = []
                for doc, own in zip(docs_[part], encode(texts[part]), strict=True):
                    ids = np.append(own, end)
                    whole = len(ids) - len(ids) % size
                    rows += [(doc, len(ids), at, size, zlib.crc32(ids[at:at + size].tobytes()), None) for at in range(0, whole, size)]
                    if rest := len(ids) - whole:
                        last = ids[whole:]
                        rows.append((doc, len(ids), whole, rest, None, last.astype("<u2").tobytes() if last.max() < 65536 else last.tobytes()))
                types = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _LIGHT)


@dataclass
class _Pool:
    """Remainders not yet placed: per length, runs (length of origin, tokens cut before, first rank, count)."""

    runs: dict[int, deque] = field(default_factory=dict)
    order: list[int] = field(default_factory=list)

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        if length and run[3]:
            if length not in self.runs:
                self.runs[length] = deque()
                insort(self.order, length)
            self.runs[length].append(run)

    def take(self, length: int, count: int) -> tuple[int, int, int, int]:
        """Up to ``count`` remainders of one run."""
        origin, cut, rank, held = self.runs[length].popleft()
        used = min(count, held)
        if used < held:
            self.runs[length].appendleft((origin, cut, rank + used, held - used))
        elif not self.runs[length]:
            del self.runs[length]
            self.order.remove(length)
        return origin, cut, rank, used


@dataclass
class Plan:
    """Where remainders go, by length and rank.

    ``slots``: (length, first rank, end rank, tokens cut before, tokens taken, first window, per window, offset).
    ``streams``: (length, first rank, end rank, tokens cut before, tokens taken, place in the stream of the first).
    ``gaps``: (place in the stream, first window, windows, offset, gap): what the stream fills.
    ``tiers``: (tier, first window, windows).
    """

    slots: list[tuple[int, ...]] = field(default_factory=list)
    streams: list[tuple[int, ...]] = field(default_factory=list)
    gaps: list[tuple[int, ...]] = field(default_factory=list)
    tiers: list[tuple[int, int, int]] = field(default_factory=list)


def plan(histogram: dict[int, int], tiers: tuple[int, ...] = TIERS) -> Plan:
    """The plan of as many remainders of each length as the histogram says."""
    out, pool, opened, streamed = Plan(), _Pool(), 0, 0
    for length, count in histogram.items():
        pool.put(length, (length, 0, 0, count))
    left = sum(length * count for length, count in histogram.items())
    ladder = [*tiers]
    while ladder[-1] > 1:  # for the last tokens, fewer than the shortest tier
        ladder.append(ladder[-1] // 2)
    for k, tier in enumerate(ladder):
        routed = tiers[k + 1] if k + 1 < len(tiers) else 0
        base, free = opened, _Pool()  # free: windows by their gap, runs (first window, -, -, count)
        while left >= tier and pool.order[-1] > routed:
            length = pool.order[-1]
            origin, cut, rank, used = pool.take(length, left // tier)
            take = min(length, tier)
            out.slots.append((origin, rank, rank + used, cut, take, opened, 1, 0))
            pool.put(length - take, (origin, cut + take, rank, used))
            free.put(tier - take, (opened, 0, 0, used))
            opened, left = opened + used, left - used * tier
        if opened > base:
            out.tiers.append((tier, base, opened - base))
        need = 0
        while free.order:
            gap = free.order[-1]
            at, fits = tier - gap, bisect_right(pool.order, gap) - 1
            first, _, _, count = free.take(gap, free.runs[gap][0][3])
            if fits < 0:
                out.gaps.append((streamed + need, first, count, at, gap))
                need += count * gap
                continue
            length = pool.order[fits]
            each, held = gap // length, pool.runs[length][0][3]
            windows, each = (min(count, held // each), each) if held >= each else (1, held)
            origin, cut, rank, used = pool.take(length, windows * each)
            out.slots.append((origin, rank, rank + used, cut, length, first, each, at))
            free.put(gap - each * length, (first, 0, 0, windows))
            free.put(gap, (first + windows, 0, 0, count - windows))
        while need:
            length = pool.order[-1]
            if length <= need:
                origin, cut, rank, used = pool.take(length, need // length)
                take = length
            else:
                origin, cut, rank, used = pool.take(length, 1)
                take = need
                pool.put(length - take, (origin, cut + take, rank, 1))
            out.streams.append((origin, rank, rank + used, cut, take, streamed))
            streamed, need = streamed + used * take, need - used * take
    return out


class Places:
    """The pieces of a remainder, found in the plan by bisection."""

    def __init__(self, made: Plan, steps: int):
        self.steps, self.tiers, self.gaps = steps, made.tiers, made.gaps
        self.tier_first, self.gap_first = [t[1] for t in made.tiers], [g[0] for g in made.gaps]
        per: dict[int, list[tuple]] = {}
        for s in made.slots:
            per.setdefault(s[0], []).append((s[1], s[2], s))
        for s in made.streams:
            per.setdefault(s[0], []).append((s[1], s[2], s))
        self.bounds, self.held = {}, {}
        for length, rows in per.items():
            bounds = sorted({x for r0, r1, _ in rows for x in (r0, r1)})
            held: list[list[tuple]] = [[] for _ in bounds]
            for r0, r1, s in rows:
                for i in range(bisect_left(bounds, r0), bisect_left(bounds, r1)):
                    held[i].append(s)
            self.bounds[length], self.held[length] = bounds, held

    def __call__(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(tokens cut before, tokens taken, window, offset) of the pieces."""
        for s in self.held[length][bisect_right(self.bounds[length], rank) - 1]:
            if len(s) == 8:
                _, r0, _, cut, take, first, each, at = s
                yield cut, take, first + (rank - r0) // each, at + (rank - r0) % each * take
                continue
            _, r0, _, cut, take, place = s
            place += (rank - r0) * take
            k = bisect_right(self.gap_first, place) - 1
            while take:
                begins, first, count, at, gap = self.gaps[k]
                nth, inside = divmod(place - begins, gap)
                if nth == count:
                    k += 1
                    continue
                used = min(take, gap - inside)
                yield cut, used, first + nth, at + inside
                cut, take, place = cut + used, take - used, place + used

    def step(self, window: int) -> tuple[int, int]:
        """The window's tier and training step."""
        tier, first, count = self.tiers[bisect_right(self.tier_first, window) - 1]
        return tier, (window - first) * self.steps // count


def multi_length_pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", tiers: tuple[int, ...] = TIERS, end_id: int = 1,
                      step_tokens: int = STEP_TOKENS, by_word: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step of every piece.

    ``tiers`` are powers of two, longest first, each half of the one before.
    """
    held = stored(remainders(docs, tokenizer, tiers[0], end_id, by_word).withColumn("at_row", F.monotonically_increasing_id()), "remainders")
    held = held.withColumn("run", F.shiftright("at_row", ROWS_BITS))
    counts = held.groupBy("length", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most tiers[0] rows
    steps = max(1, sum(length * n for length, n in histogram.items()) // step_tokens)
    made = docs.sparkSession.sparkContext.broadcast(plan(histogram, tiers))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(made.value, steps)
        for batch in batches:
            rows = []
            for doc, tokens, start, length, crc, ids, rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = None if ids is None else np.frombuffer(ids, "<u2" if len(ids) == 2 * length else "<u4").astype("<u4")
                for cut, take, window, offset in places(length, rank):
                    own_crc = crc if own is None else zlib.crc32(own[cut:cut + take].tobytes())
                    rows.append((doc, start + cut, take, own_crc, tokens, window, offset, *places.step(window)))
            names = [c.split() for c in _PLACED.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if t == "int" else pa.int64()) for c, (_, t) in zip(columns, names, strict=True)],
                                             [n for n, _ in names])

    own = Window.partitionBy("length", "run").orderBy("at_row")
    ranked = held.withColumn("k", F.row_number().over(own) - 1).join(starts, ["length", "run"])
    return ranked.select("doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids", (F.col("ahead") + F.col("k")).alias("rank")).mapInArrow(place, _PLACED)
