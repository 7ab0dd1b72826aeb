"""Removal of byte strings repeated from documents of smaller id, by suffix groups.

A string of ``LENGTH`` bytes holds the same anchors (``GRAM``-byte grams whose
rank is least within some string of that length) wherever it stands, so only
texts that share an anchor can share the string.  Equal texts are one row with
the smallest id: a copy of a larger id goes as a whole.  An anchor whose
surroundings (every such string around it) also stand under a smaller id takes
all of them, without a look at the bytes.  The first of each of several
different surroundings of one anchor bring their bytes to one bucket.  There
suffixes are ordered by linear grouping: each suffix is put in the group of its
longest Lyndon prefix, found right to left with next-smaller pointers, and the
groups, in order, are filled by following each placed suffix to the suffixes
that point to it - no group is renamed or sorted again.  Equal strings are
neighbours in that order; the smallest id wins.  A bucket of more than
``BUCKET`` rows is resolved by grouping its strings themselves instead, so no
task holds an unbounded bucket.

The texts, packed, cross the network once: the three steps that need them read
one exchange, and only places, hashes and the bytes of unequal surroundings move
beside it.  Surroundings are told apart by 112 bits of hash, texts by 96, the
strings of a large bucket by 127.

Null text is empty; texts under ``LENGTH`` bytes lose nothing.  Equal ids never
remove from each other; a null id counts as larger than any other.  Repeated
rows have one result each.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH, GRAM = 50, 24
SIDE = LENGTH - GRAM
BUCKET = 256
LAST = 2**63 - 1
GONE, ASK, SPREAD = 0, 1, 2
_ZSTD = pa.Codec("zstd", 3)
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def _gram_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 4 and of the GRAM bytes from each place: 8 by doubling, then 8 + 8 + 8."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD[0])
    for k, step in enumerate((1, 2, 4)):
        four = h
        h = h[:-step] * np.uint64(_ODD[k + 1]) + (h[step:] ^ (h[step:] >> np.uint64(29)))
    n = len(h) - 16
    h = (h[:n] * np.uint64(_ODD[4]) + h[8:n + 8]) * np.uint64(_ODD[1]) + h[16:n + 16]
    h ^= h >> np.uint64(31)
    h *= np.uint64(_ODD[2])
    return four, h ^ (h >> np.uint64(32))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of grams that rank least in some string of LENGTH bytes.

    Grams whose least four bytes stand in their middle rank first, then those
    that begin or end with them, then the rest, each by hash: such grams lie
    well apart, so a text has about a fifth fewer anchors than by hash alone.
    """
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    four, h = _gram_hashes(np.frombuffer(data, np.uint8))
    n, inner = len(h), GRAM - 4
    low = _slide(four, inner + 1, np.minimum)
    ends = (four[:n] == low) | (four[inner:inner + n] == low)
    later = np.where(four[inner // 2:inner // 2 + n] == low, np.uint64(0), np.where(ends, np.uint64(1), np.uint64(2)))
    rank = (h >> np.uint64(2)) | (later << np.uint64(62))
    least = _slide(rank, SIDE + 1, np.minimum)
    padded = np.concatenate([np.zeros(SIDE, np.uint64), least, np.zeros(SIDE, np.uint64)])
    at = np.flatnonzero(_slide(padded, SIDE + 1, np.maximum) == rank)
    return at, h[at]


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lo in range(0, len(b), 512):
            part = b.iloc[lo:lo + 512]
            data = [t.encode("utf-8", "surrogatepass") for t in part["text"]]
            yield part[["t", "u", "id"]].assign(n=[len(x) for x in data], packed=[_ZSTD.compress(x, asbytes=True) for x in data])


def _unpack(packed: bytes, n: int) -> bytes:
    return _ZSTD.decompress(packed, int(n), asbytes=True) if n else b""


def lyndon_order(strings: list[bytes]) -> list[tuple[int, int]]:
    """All suffixes (string, start) in ascending order; equal ones by string."""
    groups: dict[bytes, list[int]] = {}
    pointing: list[list[int]] = []
    group: list[list[int]] = []
    ends, places, base = [], [], 0
    for k, s in enumerate(strings):
        n = len(s)
        suffixes = [s[i:] for i in range(n + 1)]
        smaller, own = [n] * (n + 1), [[]] * (n + 1)
        to: list[list[int]] = [[] for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            j, suffix = i + 1, suffixes[i]
            while j < n and suffix < suffixes[j]:
                j = smaller[j]
            smaller[i] = j
            to[j].append(base + i)
            size = own[i] = groups.setdefault(s[i:j], [0])
            size[0] += 1
        pointing += to
        group += own
        places += [(k, i) for i in range(n + 1)]
        base += n + 1
        ends.append(base - 1)
    at = 0
    for g in sorted(groups):
        size = groups[g]
        size[0], at = at, at + size[0]
    order = [0] * at
    for e in ends:
        for i in pointing[e]:
            slot = group[i]
            order[slot[0]] = i
            slot[0] += 1
    for x in order:
        for i in pointing[x]:
            slot = group[i]
            order[slot[0]] = i
            slot[0] += 1
    return [places[x] for x in order]


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    return n - ((int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])).bit_length() + 7) // 8


def _longest_common(x: list[bytes]) -> list[int]:
    """For each string the longest prefix that it has in common with another."""
    order = sorted(range(len(x)), key=x.__getitem__)
    steps = [0, *(_common(x[i], x[j]) for i, j in zip(order, order[1:], strict=False)), 0]
    out = [0] * len(x)
    for k, i in enumerate(order):
        out[i] = max(steps[k], steps[k + 1])
    return out


def bucket_minima(rows: list[tuple[bytes, int, int]]) -> list[list[int | None]]:
    """For (surroundings, anchor place in them, smallest id): per start the smallest id of the string there.

    No string reaches beyond what its row has in common with another on a side
    of the anchor; rows that are equal when cut to that are ordered as one.
    """
    out = [[own if i <= len(s) - LENGTH else None for i in range(SIDE + 1)] for s, _, own in rows]
    if len(rows) == 1:
        return out
    left = _longest_common([s[:a][::-1] for s, a, _ in rows])
    right = _longest_common([s[a + GRAM:] for s, a, _ in rows])
    cut: dict[bytes, list[tuple[int, int]]] = {}
    for k, ((s, a, _), x, y) in enumerate(zip(rows, left, right, strict=True)):
        if x + y >= SIDE:
            cut.setdefault(s[a - x:a + GRAM + y], []).append((k, a - x))
    strings = list(cut)
    runs, before = [], None
    if len(strings) == 1:
        runs = [[(0, i)] for i in range(len(strings[0]) - LENGTH + 1)]
    else:
        for k, i in lyndon_order(strings):
            s = strings[k][i:i + LENGTH]
            if len(s) < LENGTH:
                continue
            if s != before:
                runs.append([])
            runs[-1].append((k, i))
            before = s
    same = [cut[s] for s in strings]
    smallest = [min(rows[k][2] for k, _ in x) for x in same]
    for run in runs:
        least = min(smallest[k] for k, _ in run)
        for k, i in run:
            for row, first in same[k]:
                out[row][first + i] = least
    return out


def _above(h: np.ndarray, c: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Rows above the smallest id of their surroundings in these rows."""
    order = np.argsort(c)
    same = c[order][1:] == c[order][:-1]
    at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    at = at[np.lexsort((i[at], c[at], h[at]))]
    out = np.zeros(len(c), bool)
    if len(at):
        first = np.concatenate([[True], (h[at][1:] != h[at][:-1]) | (c[at][1:] != c[at][:-1])])
        out[at] = i[at] > i[at][np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
    return out


def _emit_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """x: 48 bits of the anchor's hash, then the low 16 of its place; far: the place's other bits; c: hash of the surroundings.

    Rows known to go already, from the texts beside theirs, have only their
    place, with far inverted: an anchor that most texts hold meets once a part.
    """
    import xxhash
    for b in batches:
        for lo in range(0, len(b), 512):
            part = b.iloc[lo:lo + 512]
            n, x, far, c = [], [], [], []
            for packed, size in zip(part["packed"], part["n"], strict=True):
                data = _unpack(packed, size)
                at, h = anchors(data)
                n.append(len(at))
                x.append((h & ~np.uint64(0xFFFF)) | (at.astype(np.uint64) & np.uint64(0xFFFF)))
                far.append(at >> 16)
                c += [xxhash.xxh64_intdigest(data[p - SIDE if p > SIDE else 0:p + LENGTH], min(p, SIDE)) for p in at.tolist()]
            x, far, c, i = np.concatenate(x).view(np.int64), np.concatenate(far).astype(np.int32), np.array(c, np.uint64).view(np.int64), np.repeat(part["id"].to_numpy(), n)
            gone = _above(x >> 16, c, i)
            yield pd.DataFrame({"t": np.repeat(part["t"].to_numpy(), n), "u": np.repeat(part["u"].to_numpy(), n), "id": i,
                                "far": np.where(gone, ~far, far), "c": np.where(gone, 0, c), "x": np.where(gone, x & 0xFFFF, x)})


def _classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (anchor, surroundings, id): what their texts have to do, as place * 4 + GONE, ASK or SPREAD.

    A row above the smallest id of its surroundings is GONE.  The others, the
    firsts, wait for the end of their anchor, at most BUCKET of them.
    """
    held = pd.DataFrame({"h": [], "c": [], "id": [], "t": [], "u": [], "hit": []}, dtype=np.int64)
    last, least, spread = None, 0, None

    def settle(firsts: pd.DataFrame) -> pd.DataFrame:
        by = firsts.groupby("h", sort=False)["id"]
        n = by.transform("size")
        begun = firsts["h"] == spread if spread is not None else np.zeros(len(firsts), bool)
        firsts = firsts.assign(hit=firsts["hit"] + np.where((n > BUCKET) | begun, SPREAD, ASK))
        return firsts[begun | (by.transform("min") < by.transform("max"))]

    for b in batches:
        known = b[b["far"] < 0]
        yield known[["t", "u"]].assign(hit=(~known["far"].to_numpy().astype(np.int64) << 16 | known["x"].to_numpy()) << 2)
        b = b[b["far"] >= 0]
        if not len(b):
            continue
        h, c, i = b["x"].to_numpy() >> 16, b["c"].to_numpy(), b["id"].to_numpy()
        first = np.ones(len(b), bool)
        first[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        first[0] = last != (h[0], c[0])
        began = np.maximum.accumulate(np.where(first, np.arange(len(b)), -1))
        low = np.where(began < 0, least, i[began])
        place = (b["far"].to_numpy().astype(np.int64) << 16) | (b["x"].to_numpy() & 0xFFFF)
        rows = pd.DataFrame({"h": h, "c": c, "id": i, "t": b["t"].to_numpy(), "u": b["u"].to_numpy(), "hit": place << 2})
        last, least = (h[-1], c[-1]), low[-1]
        gone = i > low
        yield rows.loc[gone, ["t", "u", "hit"]]
        held = pd.concat([held, rows[~gone]], ignore_index=True)
        ended = held["h"] != h[-1]
        yield settle(held[ended])[["t", "u", "hit"]]
        held = held[~ended]
        if spread != h[-1]:
            spread = None
        if len(held) > BUCKET or spread is not None:
            spread = h[-1]
            yield settle(held)[["t", "u", "hit"]]
            held = held[:0]
    yield settle(held)[["t", "u", "hit"]]


def _emit_surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each surroundings of ASK; of SPREAD one for each 9 strings of one anchor (s null), with their hashes in ks."""
    import xxhash
    for b in batches:
        for lo in range(0, len(b), 128):
            rows = []
            for t, u, i, n, packed, hits in zip(*(b[c].iloc[lo:lo + 128] for c in ("t", "u", "id", "n", "packed", "hits")), strict=True):
                if hits is None:
                    continue
                asked, places = hits[hits & 3 != GONE].tolist(), {}
                data = _unpack(packed, n) if asked else b""
                for x in asked:
                    pos = x >> 2
                    a = min(pos, SIDE)
                    places.setdefault((x & 3, a, data[pos - a:pos + LENGTH]), []).append(pos - a)
                for (kind, a, s), starts in places.items():
                    gram = s[a:a + GRAM]
                    if kind == ASK:
                        rows.append((xxhash.xxh64_intdigest(gram) - 2**63, i, t, u, a, s, starts, [0]))
                        continue
                    for third in range(3):
                        first, end = max(0, a - 9 * third - 8), min(a - 9 * third, len(s) - LENGTH) + 1
                        if first < end:
                            ks = [(xxhash.xxh64_intdigest(s[j:j + LENGTH]) | 1) - 2**63 for j in range(first, end)]
                            rows.append((xxhash.xxh64_intdigest(gram, third + 1) - 2**63, i, t, u, first, None, starts, ks))
            yield pd.DataFrame(rows, columns=["g", "id", "t", "u", "a", "s", "starts", "ks"])


def _minima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (g, k, id): starts of the strings that also stand under a smaller id, as first start << (SIDE + 1) | bits."""
    bucket, rows, done = None, [], []
    last, least = None, 0

    def flush() -> None:
        found = bucket_minima([r[:3] for r in rows]) if len(rows) > 1 else []
        for (_, _, own, t, u, starts), low in zip(rows, found, strict=False):
            mask = sum(1 << j for j, v in enumerate(low) if v is not None and v < own)
            if mask:
                done.extend((t, u, int(x) << SIDE + 1 | mask) for x in starts)
        rows.clear()

    for b in batches:
        whole = b["s"].notna().to_numpy()
        for g, i, t, u, a, s, starts in b.loc[whole, ["g", "id", "t", "u", "a", "s", "starts"]].itertuples(index=False, name=None):
            if g != bucket:
                flush()
                bucket = g
            rows.append((bytes(s), a, i, t, u, starts))
        spread = b[~whole]
        if len(spread):
            g, k, i = (spread[c].to_numpy() for c in ("g", "k", "id"))
            first = np.ones(len(spread), bool)
            first[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
            first[0] = last != (g[0], k[0])
            began = np.maximum.accumulate(np.where(first, np.arange(len(spread)), -1))
            low = np.where(began < 0, least, i[began])
            last, least = (g[-1], k[-1]), low[-1]
            for t, u, a, starts in spread.loc[i > low, ["t", "u", "a", "starts"]].itertuples(index=False, name=None):
                done.extend((t, u, int(x) << SIDE + 1 | 1 << a) for x in starts)
        yield pd.DataFrame(done, columns=["t", "u", "cut"])
        done.clear()
    flush()
    yield pd.DataFrame(done, columns=["t", "u", "cut"])


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for t, u, i, n, packed, hits, cuts in zip(*(b[c] for c in ("t", "u", "id", "n", "packed", "hits", "cuts")), strict=True):
            data = _unpack(packed, n)
            step = np.zeros(len(data) + 1, np.int32)
            if hits is not None:
                pos = hits[hits & 3 == GONE] >> 2
                np.add.at(step, np.maximum(pos - SIDE, 0), 1)
                np.add.at(step, np.minimum(pos + LENGTH, len(data)), -1)
            if cuts is not None:
                row, bit = np.nonzero(cuts[:, None] >> np.arange(SIDE + 1) & 1)
                at = (cuts[row] >> SIDE + 1) + bit
                np.add.at(step, at, 1)
                np.add.at(step, at + LENGTH, -1)
            gone = np.cumsum(step[:-1]) > 0
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
            rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((t, u, i, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
        yield pd.DataFrame(rows, columns=["t", "u", "least", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.xxhash64(text).alias("t"), F.hash(text).alias("u"), text.alias("text"))
    # All three uses of the texts take the same columns, so that Spark shuffles them once.
    packed = read.select("t", "u", "id", "text").mapInPandas(_pack, "t long, u int, id long, n int, packed binary")
    once = packed.groupBy("t", "u").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("packed").alias("packed"))
    found = once.mapInPandas(_emit_anchors, "t long, u int, id long, far int, c long, x long")
    hits = (found.repartition(F.when(F.col("far") < 0, F.col("t")).otherwise(F.shiftright("x", 16))).sortWithinPartitions(F.shiftright("x", 16), "c", "id")
            .mapInPandas(_classes, "t long, u int, hit long").groupBy("t", "u").agg(F.collect_list("hit").alias("hits")))
    told = once.join(hits, ["t", "u"], "left").select("t", "u", "id", "n", "packed", "hits")
    # The strings' hashes part after the shuffle: nine of them share what their row says of the text.
    cuts = (told.mapInPandas(_emit_surroundings, "g long, id long, t long, u int, a int, s binary, starts array<int>, ks array<long>").repartition("g")
            .select("g", "id", "t", "u", "a", "s", "starts", F.posexplode("ks").alias("j", "k")).withColumn("a", F.col("a") + F.col("j")).drop("j")
            .sortWithinPartitions("g", "k", "id").mapInPandas(_minima, "t long, u int, cut long")
            .groupBy("t", "u").agg(F.collect_list("cut").alias("cuts")))
    done = told.join(cuts, ["t", "u"], "left").select("t", "u", "id", "n", "packed", "hits", "cuts").mapInPandas(
        _remove, "t long, u int, least long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    # A copy of a text under a smaller id goes as a whole.
    copy = (F.col("id") > F.col("least")) & (F.col("n_bytes") >= LENGTH)
    return read.select("doc_id", "id", "t", "u").join(done, ["t", "u"]).select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, 1).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
