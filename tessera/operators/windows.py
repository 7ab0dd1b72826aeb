"""lag / lead / rank within a key, without putting a whole key into one task.

``Window.partitionBy(key)`` sends every row of a key to one task; a key that
holds a third of the table would then sort a third of the table alone.  Here
rows are range-partitioned and sorted by (key, order), so one key spans many
tasks, and each task computes the window over its own sorted rows, batch by
batch.  What it cannot know is what lies beyond its first and last row; these
two rows per partition are carried along the partitions in one small loop, and
the result is joined back by a broadcast of one row per partition.

One range shuffle, no other exchange of the rows, and no join of the table's
size.  Null keys and null order values form groups of their own, as in a
window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ids import range_sorted

_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _code(df: DataFrame, cols: Sequence[str]) -> Column:
    """Text that is equal where the columns are equal, nulls and NaN included."""
    def plain(c: str) -> Column:
        real = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        return (F.when(F.col(c) == 0, 0.0).otherwise(F.col(c)) if real else F.col(c)).alias(c)  # -0.0 equals 0.0
    return F.to_json(F.struct(*(plain(c) for c in cols)), _MICROS)


def _shifted(first: pa.Array, rest: pa.Array) -> pa.Array:
    return pa.concat_arrays([first, rest.slice(0, len(rest) - 1)])


def _local(columns: list[str], value: str):
    """The window over one sorted partition; codes are kept at its first and last row only."""
    names = [*columns, "__part", "__pos", "__lag", "__lead", "__key_pos", "__tie_pos", "__k", "__o", "__last"]

    def emit(held: dict, next_value: pa.Array | None, follows: bool) -> pa.RecordBatch:
        batch, n = held["batch"], len(held["batch"])
        own = batch.column(value)
        later = pa.concat_arrays([own.slice(1), next_value if next_value is not None else pa.nulls(1, own.type)])
        starts = np.append(held["change"][1:], not follows)
        last = np.zeros(n, bool)
        last[-1] = next_value is None
        edge = pa.array(last | (held["pos"] == 0))
        null = pa.nulls(n, pa.string())
        data = [*(batch.column(c) for c in columns), batch.column("__part"), batch.column("__pos"),
                pc.if_else(pa.array(held["change"]), pa.nulls(n, own.type), held["before"]),
                pc.if_else(pa.array(starts), pa.nulls(n, own.type), later), pa.array(held["key_pos"]), pa.array(held["tie_pos"]),
                pc.if_else(edge, batch.column("__k"), null), pc.if_else(edge, batch.column("__o"), null), pa.array(last)]
        return pa.RecordBatch.from_arrays(data, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            own, pos = batch.column(value), batch.column("__pos").to_numpy()
            end = {c: held["batch"].column(c).slice(len(held["batch"]) - 1) if held else pa.nulls(1, batch.column(c).type)
                   for c in (value, "__k", "__o")}
            differs = {c: pc.fill_null(pc.not_equal(batch.column(c), _shifted(end[c], batch.column(c))), True).to_numpy(zero_copy_only=False)
                       for c in ("__k", "__o")}
            change, tie = differs["__k"], differs["__k"] | differs["__o"]
            since = {}
            for name, new in (("key_pos", change), ("tie_pos", tie)):
                start = np.where(new, pos, -1)
                start[0] = pos[0] if new[0] else held[name][-1]
                since[name] = np.maximum.accumulate(start)
            if held:
                yield emit(held, own.slice(0, 1), not change[0])
            held = {"batch": batch, "pos": pos, "change": change, "before": _shifted(end[value], own), **since}
        if held:
            yield emit(held, None, False)

    return run


def _carried(edges: list) -> list[tuple]:
    """Per partition: rows of its first key before it, rank of the tie that goes on, the values before and after it."""
    by_part: dict[int, list] = {}
    for e in sorted(edges, key=lambda e: (e["__part"], e["__pos"])):
        by_part.setdefault(e["__part"], []).append(e)
    out: list[list] = []
    last, count, rank = None, 0, 0  # the last row so far, how many rows its key has had, its rank
    for part, rows in by_part.items():
        first, end = rows[0], rows[-1]
        goes_on = last is not None and last["__k"] == first["__k"]
        before = count if goes_on else 0
        tie = rank if goes_on and last["__o"] == first["__o"] else None
        if goes_on:
            out[-1][5:] = [first["value"], True]
        out.append([part, before, tie, last["value"] if goes_on else None, goes_on, None, False])
        if end["__key_pos"] == 0:
            count, rank = before + end["__pos"] + 1, tie if tie is not None and end["__tie_pos"] == 0 else before + end["__tie_pos"] + 1
        else:
            count, rank = end["__pos"] - end["__key_pos"] + 1, end["__tie_pos"] - end["__key_pos"] + 1
        last = end
    return [tuple(r) for r in out]


def lag_lead_rank(df: DataFrame, key: str, order: Sequence[str], value: str,
                  prefix: str = "") -> DataFrame:
    """Add ``lag_<value>``, ``lead_<value>`` and ``rank`` over (partition by key order by order)."""
    order, kind = list(order), df.schema[value].dataType
    placed = range_sorted(df, [key, *order]).withColumns({"__k": _code(df, [key]), "__o": _code(df, order)})
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__pos", T.LongType()),
                           T.StructField("__lag", kind), T.StructField("__lead", kind), T.StructField("__key_pos", T.LongType()),
                           T.StructField("__tie_pos", T.LongType()), T.StructField("__k", T.StringType()), T.StructField("__o", T.StringType()),
                           T.StructField("__last", T.BooleanType())])
    local = placed.mapInArrow(_local(df.columns, value), schema).checkpoint()
    edges = local.where("__last or __pos = 0").select("__part", "__pos", "__key_pos", "__tie_pos", "__k", "__o", F.col(value).alias("value"))
    fixes = df.sparkSession.createDataFrame(_carried(edges.collect()), T.StructType([  # two rows a partition
        T.StructField("__part", T.IntegerType()), T.StructField("__before", T.LongType()), T.StructField("__tie", T.LongType()),
        T.StructField("__prev", kind), T.StructField("__has_prev", T.BooleanType()),
        T.StructField("__next", kind), T.StructField("__has_next", T.BooleanType())]))
    out = local.join(F.broadcast(fixes), "__part")
    rank = F.when(F.col("__key_pos") > 0, F.col("__tie_pos") - F.col("__key_pos") + 1).when(
        (F.col("__tie_pos") == 0) & F.col("__tie").isNotNull(), F.col("__tie")).otherwise(F.col("__before") + F.col("__tie_pos") + 1)
    return out.select(
        *df.columns,
        F.when((F.col("__pos") == 0) & F.col("__has_prev"), F.col("__prev")).otherwise(F.col("__lag")).alias(f"{prefix}lag_{value}"),
        F.when(F.col("__last") & F.col("__has_next"), F.col("__next")).otherwise(F.col("__lead")).alias(f"{prefix}lead_{value}"),
        rank.cast("int").alias(f"{prefix}rank"))
