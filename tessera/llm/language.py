"""Language identification by prediction with partial matching.

Per language, byte context trees up to order 2 are counted and frozen; a text's
code length is the sum over its bytes of the exact cost under that language,
with method C escapes to shorter contexts and a uniform order -1.  The shortest
code wins (ties: the first name in order).  Texts are lower-cased first.

Training takes at most ``per_lang`` whole documents a language, those of the
smallest id hashes: ids are picked first, then only their texts are read and
counted by (language, context, symbol) in the tasks; counts alone reach the
driver.  Bytes beyond the ``ALPHABET - 1`` most frequent share a class, so
the broadcast tables have ALPHABET**3 numbers a language.

Null, empty and letterless texts, or no training rows: ``und`` with score 0.
Null ids are not held out and not learned from.  Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

ALPHABET = 128
BLOCK = 1 << 20
SALTS = 16


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


def _classes(text: str, table: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(2, np.int64), table[_bytes(text)]])


def _costs(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits per symbol (last axis) from counts, escaping to the shorter context's bits."""
    total, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
    every = np.maximum(total + kinds, 1)
    escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / every), 0.0)
    return np.where(counts > 0, -np.log2(np.maximum(counts, 1) / every), escape + shorter).astype(np.float32)


def byte_classes(seen: np.ndarray) -> np.ndarray:
    """The class of each byte: 0 for all rare ones."""
    table = np.zeros(256, np.int64)
    frequent = [b for b in np.argsort(-seen, kind="stable")[:ALPHABET - 1] if seen[b]]
    table[frequent] = np.arange(1, len(frequent) + 1)
    return table


def context_codes(text: str, table: np.ndarray) -> np.ndarray:
    """Each byte with the two before it, as one number."""
    c, k = _classes(text, table), int(table.max()) + 1
    return (c[:-2] * k + c[1:-1]) * k + c[2:]


def freeze(counts: dict[str, np.ndarray], table: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, byte classes and bits[context and symbol, language] from the counts per language."""
    names, bits, k = sorted(counts), [], int(table.max()) + 1
    for name in names:
        c3 = counts[name].reshape(k, k, k)
        zero = _costs(c3.sum((0, 1)), np.full(k, 8.0))
        bits.append(_costs(c3, _costs(c3.sum(0), zero)[None]).reshape(-1))
    return names, table, np.stack(bits, axis=1)


def train(samples: list[tuple[str, str]]) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """The model of a few texts at hand."""
    if not samples:
        return None
    table = byte_classes(sum(np.bincount(_bytes(t), minlength=256) for _, t in samples))
    counts = {lang: np.zeros((int(table.max()) + 1) ** 3, np.int64) for lang, _ in samples}
    for lang, text in samples:
        counts[lang] += np.bincount(context_codes(text, table), minlength=len(counts[lang]))
    return freeze(counts, table)


def _counted(texts: DataFrame, codes: Callable[[str], np.ndarray]) -> DataFrame:
    """lang, code, n over whole texts (lang, text): summed per batch before they are shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                at, n = np.unique(codes(text), return_counts=True)
                yield pd.DataFrame({"lang": lang, "code": at, "n": n})

    return texts.mapInPandas(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def train_on(texts: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """The model of a table (lang, text) of some whole documents; at most 256 + ALPHABET**3 counts a language reach the driver."""
    seen = np.zeros(256, np.int64)
    for r in _counted(texts, _bytes).groupBy("code").agg(F.sum("n").alias("n")).collect():
        seen[r["code"]] = r["n"]
    table, counts = byte_classes(seen), {}
    for r in _counted(texts, lambda t: context_codes(t, table)).toLocalIterator():
        counts.setdefault(r["lang"], np.zeros((int(table.max()) + 1) ** 3, np.int64))[r["code"]] = r["n"]
    return freeze(counts, table) if counts else None


def code_lengths(text: str, table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    k = round(len(bits) ** (1 / 3))
    c, out = _classes(text, table), np.zeros(bits.shape[1])
    for lo in range(0, len(c) - 2, BLOCK):
        x = c[lo:lo + BLOCK + 2]
        out += bits[(x[:-2] * k + x[1:-1]) * k + x[2:]].sum(0, dtype=np.float64)
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, per_lang: int = 300) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    some = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # First per (lang, salt): no task gets more than SALTS * per_lang ids of a language in the end.
    ids = some.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct().withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)))
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))
    few = ids.withColumn("k", first("lang", "salt")).where(F.col("k") <= per_lang).drop("k")
    # Written, so that Spark knows their size and need not shuffle the texts to meet a few ids.
    picked = stored(few.withColumn("k", first("lang")).where(F.col("k") <= per_lang).select("lang", "doc_id"), "training-ids")
    held = some.select("lang", "doc_id", "text").join(picked, ["lang", "doc_id"], "left_semi")  # of an id's rows one text
    texts = stored(held.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text"), "training-texts")
    model = train_on(texts)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(text: str | None) -> tuple[str, float]:
            if not text or shared.value is None or not any(map(str.isalpha, text)):
                return "und", 0.0
            names, table, bits = shared.value
            lengths = code_lengths(text, table, bits)
            best = int(lengths.argmin())
            return names[best], float(1 / np.exp2(np.clip(lengths[best] - lengths, -1000, 0)).sum())

        for b in batches:
            said = [one(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "held_out": b["held_out"],
                                "lang_pred": [x for x, _ in said], "score": [y for _, y in said]})

    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInPandas(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
