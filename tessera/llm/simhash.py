"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints are made per text in Arrow batches, equal ones become one class,
and the distinct values form a binary trie.  The join walks pairs of trie nodes
together, adds up the bits in which they differ and drops a pair once the sum
passes ``max_bits``.  The first levels (about log2 of the
distinct values over ``SUBTREE``) are walked as Spark rows (one
copy of a value per node pair it can take part in), the rest inside the task
that owns the pair of subtrees, over blocks of bounded size.  A task returns a
spanning forest of its links, never all pairs of a group.

Null and empty texts have fingerprint zero and link like any other.  Repeated
rows stay; null ids stay and take the component of their class (null when the
whole class has no id).  Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SPACE_WORD, UPPER, stored
from tessera.llm.components import connected_components

SUBTREE = 4096  # distinct values per subtree that sets how many levels are walked as rows
BLOCK = 1 << 19
_TABLE = str.maketrans(UPPER, LOWER)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    w = re.findall(SPACE_WORD, (text or "").translate(_TABLE))
    if not w:
        return 0
    if len(w) < shingle:
        grams = [" ".join(w)]
    else:
        grams = map(" ".join, zip(*(w[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    total, n, part = np.zeros(64, np.int64), 0, []

    def add() -> None:
        nonlocal total, n
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total, n = total + bits.sum(axis=0, dtype=np.int64), n + len(part)
        part.clear()

    for g in grams:
        part.append(digest(g.encode("utf-8", "surrogatepass"), 42))
        if len(part) == 65536:
            add()
    if part:
        add()
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), text_hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fp": fp, "text_hash": b["text_hash"]})

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(run, "doc_id long, fp long, text_hash long")


class Trie:
    """Levels of a binary trie over sorted distinct values: node -> range of values."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def children(self, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        """Where the 1-child of nodes [lo, hi) starts; values share all higher bits."""
        base = (self.values[lo] >> np.uint64(bit + 1)) << np.uint64(bit + 1)
        return np.clip(np.searchsorted(self.values, base | np.uint64(1 << bit)), lo, hi)


def trie_links(a: np.ndarray, b: np.ndarray, budget: int, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted ``a`` and ``b`` within ``budget`` bits below bit ``top``.

    ``a is b`` joins a trie with itself (pairs with i < j).  Blocks of node pairs
    are on a stack, so at most a few blocks are held at a time.
    """
    ta, tb, same = Trie(a), Trie(b), a is b
    zero = np.zeros(1, np.int64)
    stack = [(top, zero, zero + len(a), zero, zero + len(b), np.zeros(1, np.int64))]
    low = lambda bit: np.uint64((1 << (bit + 1)) - 1)
    while stack:
        bit, al, ah, bl, bh, err = stack.pop()
        if len(al) > BLOCK:
            for part in (slice(len(al) // 2, None), slice(None, len(al) // 2)):
                stack.append((bit, al[part], ah[part], bl[part], bh[part], err[part]))
            continue
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any() or bit < 0:
            i, j, e = al[leaf], bl[leaf], err[leaf]
            if bit >= 0:
                e = e + np.bitwise_count((a[i] ^ b[j]) & low(bit))
            ok = (e <= budget) & ((i < j) if same else True)
            if ok.any():
                yield i[ok], j[ok]
            al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
        if not len(al) or bit < 0:
            continue
        am, bm = ta.children(al, ah, bit), tb.children(bl, bh, bit)
        own = same & (al == bl) & (ah == bh)
        parts = []
        for x0, x1, y0, y1, d in ((al, am, bl, bm, 0), (am, ah, bm, bh, 0), (al, am, bm, bh, 1), (am, ah, bl, bm, 1)):
            ok = (x1 > x0) & (y1 > y0) & (err + d <= budget)
            if d and x0 is am:
                ok &= ~own  # the mirror image of the pair before
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], err[ok] + d))
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """The pairs that join two parts so far apart, at most n - 1 of them."""
    up, out = np.arange(n), []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, j in pairs:
        open_ = up[i] != up[j]
        for x, y in zip(i[open_].tolist(), j[open_].tolist(), strict=True):
            p, q = root(x), root(y)
            if p != q:
                up[q] = p
                out.append((x, y))
    return out


def _join_subtrees(budget: int, prefix: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(v)
        v, node = v[order], pdf["node"].to_numpy()[order]
        mask = int(pdf["mask"].iloc[0])
        top = 63 - prefix
        if mask == 0:
            links = _forest(len(v), trie_links(v, v, budget, top))
        else:
            side = (v >> np.uint64(64 - prefix)) == (v[0] >> np.uint64(64 - prefix))
            cut, low = int(side.sum()), np.uint64((1 << (top + 1)) - 1)
            if cut == len(v):
                links = []
            else:
                left = budget - mask.bit_count()
                links = _forest(len(v), ((i, j + cut) for i, j in trie_links(v[:cut] & low, v[cut:] & low, left, top)))
        return pd.DataFrame([(node[i], node[j]) for i, j in links], columns=["u", "v"]).astype("int64")
    return run


def link_classes(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Spanning links (u, v) between the nodes of distinct fingerprints (fp, node)."""
    depth = min(24, max(4, math.ceil(math.log2(max(1, classes.count()) / SUBTREE))))
    masks = [sum(1 << b for b in bits) for n in range(max_bits + 1) for bits in combinations(range(depth), n)]
    prefix = F.shiftrightunsigned("fp", 64 - depth)
    pairs = (classes.select("fp", "node", prefix.alias("p"), F.explode(F.array(*map(F.lit, masks))).alias("mask"))
             .select("fp", "node", "mask", F.least("p", F.col("p").bitwiseXOR(F.col("mask"))).alias("p")))
    return pairs.groupBy("p", "mask").applyInPandas(_join_subtrees(max_bits, depth), "u long, v long").distinct()


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), class_id, text_hash.

    class_id is component_id, or a stand-in for a component without any id.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    # Classes without any id get a node of their own below all ids, turned to null at the end.
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("id")).select(
        "fp", "id", F.coalesce("id", F.lit(2**62) + F.abs(F.xxhash64("fp")) % F.lit(2**61)).alias("node")), "classes")
    comp = connected_components(link_classes(classes, max_bits))
    named = classes.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("c"))
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        F.when(F.col("c") < 2**62, F.col("c")).alias("component_id"), F.col("c").alias("class_id"), "text_hash")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row of smallest id stays, once."""
    keys = [F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("text_hash").alias("t")]
    first = (simhash_dedup(docs, shingle, max_bits).groupBy("class_id").agg(F.min(F.struct(*keys)).alias("k")).select("k.id", "k.t"))
    rows = docs.select(F.expr("struct(*)").alias("row"), F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.xxhash64("text").alias("t"))
    return rows.join(first, ["id", "t"], "left_semi").dropDuplicates(["id", "t"]).select("row.*")
