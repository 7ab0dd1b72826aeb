"""Distinct counts per fine cell that roll up to coarser cells without reading rows again.

A count of distinct values cannot be added up, its state can.  Per fine cell one
aggregate keeps, in one pass over the rows and without copying them per column:

* the set of values of every ``exact`` column.  These are columns of few values,
  such as event flags: a set is as large as the number of its values;
* a sketch of every ``sketched`` column, of fixed size however many values it has.

Both merge: sets by a union of their members, sketches by ``hll_union_agg``.  For
exact counts of a column of many values, ``exact_pairs`` keeps one row per (fine
cell, value), which rolls up the same way.  Nulls are not values; a null cell is
a cell of its own; an empty table gives no cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cell_state(df: DataFrame, cells: Sequence[str], exact: Sequence[str], sketched: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """Per cell (all of ``cells``): n_rows, ``set_<column>`` and ``sketch_<column>``."""
    return df.groupBy(*cells).agg(
        F.count("*").alias("n_rows"), *(F.collect_set(c).alias(f"set_{c}") for c in exact),
        *(F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"sketch_{c}") for c in sketched))


def _columns(state: DataFrame, kind: str) -> list[str]:
    return [c.removeprefix(f"{kind}_") for c in state.columns if c.startswith(f"{kind}_")]


def state_counts(state: DataFrame) -> DataFrame:
    """``<column>_count`` from the sets, ``<column>_approx`` from the sketches."""
    cells = [c for c in state.columns if c != "n_rows" and not c.startswith(("set_", "sketch_"))]
    return state.select(*cells, "n_rows", *(F.size(f"set_{c}").cast("long").alias(f"{c}_count") for c in _columns(state, "set")),
                        *(F.hll_sketch_estimate(f"sketch_{c}").alias(f"{c}_approx") for c in _columns(state, "sketch")))


def roll_up(state: DataFrame, cell: str) -> DataFrame:
    """The state per ``cell``, one of the state's cells, from the finer states.

    Members of all sets are first made distinct per (cell, column), so a coarse
    cell with many fine cells never gathers their sets in one task.
    """
    exact, sketched = _columns(state, "set"), _columns(state, "sketch")
    totals = state.groupBy(cell).agg(F.sum("n_rows").alias("n_rows"), *(F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in sketched))
    if not exact:
        return totals
    kinds = [state.schema[f"set_{c}"].dataType.elementType for c in exact]

    def tagged(i: int):  # members of one set, each in its column's field
        return F.transform(f"set_{exact[i]}", lambda v: F.struct(F.lit(i).alias("column"), *(
            (v if j == i else F.lit(None)).cast(kind).alias(f"v{j}") for j, kind in enumerate(kinds))))

    members = state.select(cell, F.explode(F.flatten(F.array(*map(tagged, range(len(exact)))))).alias("m")).select(cell, "m.*").distinct()
    sets = members.groupBy(F.col(cell).alias("__cell")).agg(*(F.collect_list(f"v{i}").alias(f"set_{c}") for i, c in enumerate(exact)))
    empty = [F.coalesce(f"set_{c}", F.array().cast(state.schema[f"set_{c}"].dataType)).alias(f"set_{c}") for c in exact]
    return (totals.join(sets, totals[cell].eqNullSafe(sets["__cell"]), "left")
            .select(cell, "n_rows", *empty, *(f"sketch_{c}" for c in sketched)))


def exact_pairs(df: DataFrame, cells: Sequence[str], column: str) -> DataFrame:
    """One row per (cell, value): the exact state of a column of many values."""
    return df.select(*cells, column).where(F.col(column).isNotNull()).distinct()


def pair_counts(pairs: DataFrame, cell: str, column: str) -> DataFrame:
    """Distinct values per ``cell`` of the pairs' cells."""
    return pairs.select(cell, column).distinct().groupBy(cell).agg(F.count("*").alias(f"{column}_count"))
