"""Importance resampling towards a target distribution.

Word n-grams are hashed into buckets.  A bucket's gain is the log ratio of its
share in the target over its share in the corpus; a document's weight is the
floored mean gain of its features, looked up in one array of gains.  Adding
Gumbel noise fixed by the document's id and keeping the highest scores draws
documents in proportion to their weights.  Ranks come from the radix sort.

Counts over the corpus are summed per task before they are shuffled: a task
sends one row per bucket at most.  The gains are ``buckets`` numbers, whatever
the corpus.

Nulls and empty texts have no features and weight 0.  A null id is hashed as an
empty one and comes after other ids in ties.  Repeated rows count and are drawn
each on its own.  Very long texts are read whole, one at a time.  Empty tables
give empty results; an empty target gives gains from the counts plus one.  Only
the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, stored
from tessera.llm.radix import radix_rank

BUCKETS = 10_000
#: ASCII that is neither letter nor digit parts words; bytes above ASCII belong to them.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


class Features:
    """Bucket numbers of a text's word n-grams; a word's bucket is computed once while remembered."""

    MEMO = 1 << 19

    def __init__(self, ngram: int, buckets: int):
        self.ngram, self.buckets, self.memo = ngram, buckets, {}

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of words, and the buckets of all features."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(_PARTS).split()
        grams = list(words)
        for n in range(2, self.ngram + 1):
            grams += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        if len(self.memo) > self.MEMO:
            self.memo = {}
        for gram in set(grams).difference(self.memo):
            self.memo[gram] = zlib.crc32(gram) % self.buckets
        return len(words), np.fromiter(map(self.memo.__getitem__, grams), np.int64, len(grams))


def bucket_counts(texts: DataFrame, ngram: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features per bucket over all rows of ``text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(ngram, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py())[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, ngram: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket: floor(1000 ln of the smoothed target share over the smoothed corpus share)."""
    counts = [dict.fromkeys(range(buckets), 0) | {r["bucket"]: r["n"] for r in bucket_counts(t, ngram, buckets).collect()} for t in (docs, target)]
    s, t = (np.array([c[b] for b in range(buckets)], np.float64) for c in counts)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def scored(docs: DataFrame, gains: np.ndarray, ngram: int = 1, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    table = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def noise(doc) -> int:
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, features = table.value, Features(ngram, len(table.value))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                words, found = features(text.as_py())
                doc, weight = doc.as_py(), int(gain[found].sum()) // len(found) if len(found) else 0
                rows.append((doc, words, len(found), weight, weight + noise(doc)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, ngram: int = 1,
                        buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; undrawn ones have a null rank.

    Drawn are the highest scores, ``percent`` of the documents with at least ``min_words`` words, ties to the smaller id.
    """
    rows = stored(scored(docs, bucket_gains(docs, target, ngram, buckets), ngram, seed), "scores")
    long_enough = rows.where(F.col("n_words") >= min_words)
    drawn = percent * long_enough.count() // 100
    ranked = radix_rank(long_enough, [("score", True), ("doc_id", False)], "place")
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank).unionByName(
        rows.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank")))
