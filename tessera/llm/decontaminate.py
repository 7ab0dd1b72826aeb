"""Benchmark decontamination by suffix arrays over the training texts.

Each task cuts its documents into shards of bounded size, numbers their words by
the benchmark's vocabulary and keeps a suffix array (by the first ``WINDOW``
words) of every place that can begin a match.  All benchmark windows are
binary-searched in it; the range found gives the places.  A hit is extended
along one diagonal of one item (document place minus item place) only: a match
begins where the words before differ and ends where the words after differ.

The benchmark is broadcast after its words are counted: above ``MAX_WORDS`` the
call is refused, so the broadcast has a known bound.  Null or empty texts have
no words and no hits; repeated rows are judged alike; a null item id is named
``null``; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ALNUM_WORD, LOWER, UPPER, ascii_lower, words

WINDOW = 10
HEAD = 3
SHARD_CHARS = 8 << 20
MAX_WORDS = 20_000_000
_TABLE = str.maketrans(UPPER, LOWER)
_WORD = re.compile(ALNUM_WORD)
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, text_hash long"
MATCHES = "matches array<struct<item:string,item_at:long,doc_at:long,length:long>>"
PAIRS = 1 << 20


def _keys(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The WINDOW word numbers from each place as sortable bytes."""
    rows = np.ascontiguousarray(ids[at[:, None] + np.arange(WINDOW)].astype(">u4"))
    return rows.view(f"S{4 * WINDOW}").reshape(-1)


class Benchmark:
    """Vocabulary, distinct windows with their items and places, and the heads of windows.

    ``flat`` holds the words of all items with a -1 around each; the places of
    window k in it are ``places[first[k]:first[k + 1]]``.
    """

    def __init__(self, items: list[tuple[str, list[str]]]):
        self.vocab: dict[str, int] = {}
        found: dict[tuple[int, ...], list[int]] = {}
        self.names, begin, flat = [name for name, _ in items], [], [np.full(1, -1)]
        at = 1
        for _, w in items:
            ids = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in w]
            for i in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                found.setdefault(tuple(ids[i:i + WINDOW]), []).append(at + i)
            begin.append(at)
            flat += (np.array(ids, np.int64), np.full(1, -1))
            at += len(ids) + 1
        self.begin, self.flat = np.array(begin, np.int64), np.concatenate(flat).astype(np.int64)
        self.windows = list(found)
        self.first = np.cumsum([0, *map(len, found.values())])
        self.places = np.fromiter((p for ps in found.values() for p in ps), np.int64)
        owner = np.searchsorted(self.begin, self.places, "right") - 1
        self.items = [{self.names[i] for i in owner[a:b]} for a, b in zip(self.first[:-1], self.first[1:], strict=True)]
        pad = lambda fill: np.array([[*w, *[fill] * (WINDOW - len(w))] for w in self.windows], ">u4").reshape(-1, WINDOW)
        view = lambda a: np.ascontiguousarray(a).view(f"S{4 * WINDOW}").reshape(-1)
        self.low, self.high = view(pad(0)), view(pad(0xFFFFFFFF))
        self.size = np.array([len(w) for w in self.windows], np.int64)
        heads = [w[:HEAD] for w in self.windows if len(w) >= HEAD]
        self.heads = np.unique(_code(*np.array(heads, np.uint64).reshape(-1, HEAD).T))
        self.firsts = np.unique(np.array([w[0] for w in self.windows if len(w) < HEAD], np.int64))


def _code(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One number for three words; a clash only adds a place to the suffix array."""
    return (a << np.uint64(42)) | (b << np.uint64(21)) ^ (c * np.uint64(0x9E3779B97F4A7C15))


def _codes(x: np.ndarray) -> np.ndarray:
    return _code(*(x[i:len(x) - HEAD + 1 + i].astype(np.uint64) for i in range(HEAD)))


def _ends(ids: np.ndarray, hit: np.ndarray, bench: Benchmark, k: int, step: int) -> np.ndarray:
    """Rows (diagonal, place, window size) of the pairs of window k whose words ``step`` further differ."""
    at, out = bench.places[bench.first[k]:bench.first[k + 1]], []
    rows = max(1, PAIRS // len(hit))
    for a in range(0, len(at), rows):
        q = at[a:a + rows]
        for b in range(0, len(hit), PAIRS):
            p = hit[b:b + PAIRS]
            i, j = np.nonzero(ids[p + step][:, None] != bench.flat[q + step][None, :])
            out.append(np.stack([p[i] - q[j], p[i], np.full(len(i), bench.size[k])], 1))
    return np.concatenate(out)


def _ordered(ends: list[np.ndarray]) -> np.ndarray:
    e = np.concatenate([np.zeros((0, 3), np.int64), *ends])
    return e[np.lexsort((e[:, 1], e[:, 0]))]


def search(texts: list[str | None], bench: Benchmark) -> list[tuple]:
    """Per text: n_words, n_hit, item names, matches (item, item word, text word, words)."""
    get, parts, starts, at = bench.vocab.get, [], [], 0
    lengths = []
    for t in texts:
        ids = [get(w, 0) for w in _WORD.findall((t or "").translate(_TABLE))]
        starts.append(at)
        lengths.append(len(ids))
        parts += (np.array(ids, np.int64), np.zeros(1, np.int64))
        at += len(ids) + 1
    ids = np.concatenate([*parts, np.zeros(WINDOW, np.int64)])
    cover = np.zeros(len(ids) + 1, np.int64)
    items: dict[int, set[str]] = {}
    begin = np.array(starts, np.int64)
    mask = np.zeros(len(ids), bool)
    mask[:len(ids) - HEAD + 1] = np.isin(_codes(ids), bench.heads)
    mask |= np.isin(ids, bench.firsts)
    mask[len(ids) - WINDOW:] = False
    places = np.flatnonzero(mask)
    left, right = [], []
    if len(places) and len(bench.windows):
        keys = _keys(ids, places)
        order = np.argsort(keys, kind="stable")
        suffixes, places = keys[order], places[order]
        lo, hi = np.searchsorted(suffixes, bench.low, "left"), np.searchsorted(suffixes, bench.high, "right")
        for k in np.flatnonzero(hi > lo).tolist():
            hit = places[lo[k]:hi[k]]
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + bench.size[k], -1)
            left.append(_ends(ids, hit, bench, k, -1))
            right.append(_ends(ids, hit, bench, k, int(bench.size[k])))
            for d in np.unique(np.searchsorted(begin, hit, "right") - 1).tolist():
                items.setdefault(d, set()).update(bench.items[k])
    covered = np.cumsum(cover)[:-1] > 0
    # In order of diagonals and places the n-th beginning and the n-th end belong to one match.
    left, right = _ordered(left), _ordered(right)
    doc = np.searchsorted(begin, left[:, 1], "right") - 1
    flat = left[:, 1] - left[:, 0]
    item = np.searchsorted(bench.begin, flat, "right") - 1
    matches: dict[int, set[tuple]] = {}
    for d, i, q, p, n in zip(doc.tolist(), item.tolist(), flat.tolist(), left[:, 1].tolist(), (right[:, 1] - left[:, 1] + right[:, 2]).tolist(), strict=True):
        matches.setdefault(d, set()).add((bench.names[i], q - int(bench.begin[i]), p - starts[d], n))
    return [(n, int(covered[s:s + n].sum()), items.get(d, set()), sorted(matches.get(d, ()), key=lambda m: (m[2], m[0], m[1])))
            for d, (s, n) in enumerate(zip(starts, lengths, strict=True))]


def contamination(docs: DataFrame, benchmark: DataFrame, with_matches: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, text_hash.

    ``with_matches`` adds ``matches``: the longest verbatim matches as (item, item_at,
    doc_at, length), counted in words from 0, by doc_at.
    """
    schema = f"{SCHEMA}, {MATCHES}" if with_matches else SCHEMA
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), words(ascii_lower(F.col("text")), ALNUM_WORD).alias("w"))
    total = items.agg(F.sum(F.size("w"))).first()[0] or 0
    if total > MAX_WORDS:
        raise ValueError(f"benchmark of {total} words; pass it in parts of at most {MAX_WORDS}")
    shared = spark.sparkContext.broadcast(Benchmark([(r["i"], r["w"]) for r in items.toLocalIterator()]))

    columns = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = b["text"].map(lambda t: len(t or "") + 1).cumsum().to_numpy()
            for _, part in b.groupby(size // SHARD_CHARS, sort=False):
                rows = []
                for doc, key, (n, hit, names, found) in zip(part["doc_id"], part["text_hash"], search(part["text"].tolist(), shared.value), strict=True):
                    said = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
                    rows.append((None if pd.isna(doc) else int(doc), n, hit, len(names), said, hit > 0, max((m[3] for m in found), default=0), key,
                                 [dict(zip(("item", "item_at", "doc_at", "length"), m, strict=True)) for m in found])[:len(columns)])
                yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(run, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark window."""
    bad = (contamination(docs, benchmark).where("contaminated").select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("text_hash").alias("t")).distinct())
    rows = docs.select(F.expr("struct(*)").alias("row"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.xxhash64("text").alias("t"))
    return rows.join(bad, ["id", "t"], "left_anti").select("row.*")
