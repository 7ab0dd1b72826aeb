"""Best-fit packing planned on the histogram of lengths.

Texts become pieces of at most ``size`` tokens.  The plan packs counts, not
documents: lengths in descending order fill the tightest open sequences, whole
runs of equal sequences at a time.  It has at most ``size`` lengths as input
and a few rows per length as output, so it is small at any corpus size.  Pieces
then take their planned slot by joining on their rank within their length.
Ranks are counted per (length, run of rows), so one length may hold any share
of the rows.  Pieces of the full size are sequences as they are.

Null and empty texts are one piece holding the end id.  Repeated rows get slots
of their own.  Very long texts are encoded one at a time.  An empty table gives
an empty result.  Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.tokens import worker_encoder

ROWS_BITS = 20  # rows ranked together: 2**20 of one length at most
BATCH = 64
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized(docs: DataFrame, tokenizer: str, size: int, end_id: int, by_word: bool = True) -> DataFrame:
    """One row per piece; ids are not kept beyond their checksum.

    ``by_word`` is for tokenizers as in tokens.py; without it whole texts are encoded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names = worker_encoder(tokenizer, by_word), [c.split()[0] for c in PIECE.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            ids_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), BATCH):
                rows = []
                for doc, own in zip(ids_[at:at + BATCH], encode(texts[at:at + BATCH]), strict=True):
                    ids = np.append(own, np.array([end_id], "<u4"))
                    rows += [(doc, k, s, len(ids[s:s + size]), zlib.crc32(ids[s:s + size].tobytes()))
                             for k, s in enumerate(range(0, len(ids), size))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, items per sequence, offset).

    Open sequences are kept as runs (first, count) by free room.  A length takes
    the smallest room that holds it, and fills a sequence as often as it fits
    before the next, which is what best fit does item by item.
    """
    rooms: dict[int, deque[tuple[int, int]]] = {}
    order: list[int] = []
    rows, opened = [], 0

    def put(room: int, first: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in rooms:
                rooms[room] = deque()
                insort(order, room)
            rooms[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(order, length)
            if k < len(order):
                room = order[k]
                first, count = rooms[room].popleft()
                if not rooms[room]:
                    del rooms[room], order[k]
            else:
                room, first = size, opened
                count = -(-left // (size // length))
                opened += count
            each = room // length
            full = min(count, left // each)
            if full:
                rows.append((length, rank, rank + full * each, first, each, size - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count and left:  # fewer than `each` remain: one sequence takes them
                rows.append((length, rank, rank + left, first + full, left, size - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, count - full)
    return rows


def best_fit_pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", size: int = 4096, end_id: int = 1,
                  by_word: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stored(tokenized(docs, tokenizer, size, end_id, by_word).withColumn("at_row", F.monotonically_increasing_id()), "pieces")
    parts = pieces.where(F.col("length") < size).withColumn("run", F.shiftright("at_row", ROWS_BITS))
    counts = parts.groupBy("length", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    rows = plan(histogram, size)
    slots = spark.createDataFrame(rows, "length long, r0 long, r1 long, first long, each long, at long")
    own = Window.partitionBy("length", "run").orderBy("at_row")
    ranked = (parts.withColumn("k", F.row_number().over(own) - 1).join(starts, ["length", "run"])
              .withColumn("rank", F.col("base") + F.col("k")))
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= r0 and rank < r1")
    nth = F.col("rank") - F.col("r0")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    opened = max((first + -(-(r1 - r0) // each) for _, r0, r1, first, each, _ in rows), default=0)
    whole = pieces.where(F.col("length") == size).select(*columns, (F.col("at_row") + opened).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.select(*columns, (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("at") + nth % F.col("each") * F.col("length")).cast("long").alias("offset")).unionByName(whole)
