"""String expressions: key cleaning, coordinate text, keyword classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading or trailing whitespace of any kind (spaces, tabs, newlines, ...).
# Spark's trim() removes only the space character, so tab-polluted keys survive it.
_EDGE_WHITESPACE = r"^\s+|\s+$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_key(c) -> Column:
    """Strip every leading/trailing whitespace character (tabs included)."""
    return F.regexp_replace(_as_col(c), _EDGE_WHITESPACE, "")


def coordinate_text(lat, lon, sep: str = ", ", wrap: tuple[str, str] | None = None) -> Column:
    """"lat, lon" text (or "(lat, lon)" with ``wrap=("(", ")")``); NULL if either part is NULL."""
    parts = [_as_col(lat).cast("string"), F.lit(sep), _as_col(lon).cast("string")]
    if wrap:
        parts = [F.lit(wrap[0]), *parts, F.lit(wrap[1])]
    return F.concat(*parts)


def classify_by_keywords(c, rules: Sequence[tuple[str, str]], default: str | None = None,
                         case_sensitive: bool = True) -> Column:
    """First matching rule wins: ``rules`` is an ordered list of (substring, label).

    Equivalent to ``CASE WHEN c LIKE '%kw%' THEN label ... ELSE default END``;
    written with ``contains`` so no LIKE escaping is needed.  A NULL input
    falls through to ``default``.
    """
    col = _as_col(c)
    if not case_sensitive:
        col = F.lower(col)
    expr = None
    for keyword, label in rules:
        kw = keyword if case_sensitive else keyword.lower()
        cond = F.coalesce(col.contains(kw), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
