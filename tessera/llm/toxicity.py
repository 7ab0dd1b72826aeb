"""Toxicity grades by cumulative-link ordinal regression.

Grades come from labels: 0 not toxic, 1 toxic, 2 toxic and of low quality.  The
features are the distinct words of a text, hashed; one weight vector is shared
by both ordered thresholds, P(grade > k) = sigmoid(w.x - t_k), and the output is
the expected grade.  Weights are fitted with an L1 penalty on at most
``max_train`` labelled documents (smallest id hashes), a documented bound;
scoring reads every whole text.  Without labelled rows the severity is 0.

Null, empty and wordless texts have no features and severity 0 (not toxic).
Several labels of one id count as the highest; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ALNUM_WORD

BUCKETS = 1 << 18
_WORD = re.compile(ALNUM_WORD)


def features(text: str | None) -> np.ndarray:
    seen = set(_WORD.findall((text or "").lower()))
    return np.array(sorted({xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in seen}), np.int64)


def fit(rows: list[np.ndarray], grades: np.ndarray, rounds: int = 300, penalty: float = 1.0, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the two thresholds, by proximal AdaGrad on the cumulative-link likelihood."""
    n = len(rows)
    w, t = np.zeros(BUCKETS), np.array([1.0, 3.0])
    if n == 0:
        return w, np.array([50.0, 51.0])
    who = np.repeat(np.arange(n), [len(r) for r in rows])
    what = np.concatenate(rows) if len(who) else np.empty(0, np.int64)
    often = np.bincount(what, minlength=BUCKETS)
    ok = (often[what] >= least) & (often[what] <= 0.5 * n)
    who, what = who[ok], what[ok]
    gw, gt, sig = np.full(BUCKETS, 1e-6), np.full(2, 1e-6), lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for _ in range(rounds):
        z = np.bincount(who, w[what], minlength=n)
        p1, p2 = sig(z - t[0]), sig(z - t[1])
        p = np.maximum(np.choose(grades, [1 - p1, p1 - p2, p2]), 1e-9)
        d1, d2 = p1 * (1 - p1), p2 * (1 - p2)
        dz = np.choose(grades, [d1, d2 - d1, -d2]) / p
        g1, g2 = (np.choose(grades, [-d1, d1, 0 * d1]) / p).sum(), (np.choose(grades, [0 * d1, -d2, d2]) / p).sum()
        g = np.bincount(what, dz[who], minlength=BUCKETS)
        gw += g * g
        gt += np.array([g1, g2]) ** 2
        rate = 0.5 / np.sqrt(gw)
        w = w - rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
        t = t - 0.5 / np.sqrt(gt) * np.array([g1, g2])
        t[1] = max(t[1], t[0] + 0.05)
    return w, t


def severity(docs: DataFrame, labels: DataFrame, max_train: int = 4000) -> DataFrame:
    """doc_id, severity (0 to 2), p_toxic, p_severe, toxic."""
    spark = docs.sparkSession
    graded = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max(F.expr("case when toxic = 0 then 0 when quality = 0 then 2 else 1 end")).alias("g"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(graded), "doc_id").dropDuplicates(["doc_id"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": b["g"], "x": [features(t).tolist() for t in b["text"]]})

    got = texts.select("text", "g").mapInPandas(read, "g int, x array<int>").collect()  # at most max_train rows
    shared = spark.sparkContext.broadcast(fit([np.array(r["x"], np.int64) for r in got], np.array([r["g"] for r in got], np.int64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, t = shared.value
        for b in batches:
            x = [features(a) for a in b["text"]]
            z = np.array([w[a].sum() for a in x])
            p = 1 / (1 + np.exp(-np.clip(z[:, None] - t[None, :], -40, 40))) * np.array([[len(a) > 0] for a in x])
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "severity": p.sum(1), "p_toxic": p[:, 0], "p_severe": p[:, 1], "toxic": p[:, 0] >= 0.5})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, severity double, p_toxic double, p_severe double, toxic boolean")
