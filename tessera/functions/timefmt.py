"""Time parsing and formatting expressions (time-zone independent)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c, pattern: str = "yyyyMMddHHmm") -> Column:
    """Digits such as ``202308231600`` (string or integer) to ``timestamp_ntz``.

    The text is rebuilt as ISO date and time and cast straight to a wall-clock
    timestamp, so no session zone is involved and hours that a zone skips stay.
    Text of another length, with other characters or with an impossible date
    gives NULL.  ``pattern`` may order yyyy, MM, dd, HH, mm, ss freely.
    """
    text = _as_col(c).cast("string")
    part = lambda unit, default: F.substring(text, pattern.index(unit) + 1, len(unit)) if unit in pattern else F.lit(default)
    shape = "".join(r"\d" if ch in "yMdHms" else re.escape(ch) for ch in pattern)
    day = F.concat_ws("-", part("yyyy", "1970"), part("MM", "01"), part("dd", "01"))
    time = F.concat_ws(":", part("HH", "00"), part("mm", "00"), part("ss", "00"))
    return F.when(text.rlike(f"^{shape}$"), F.concat_ws(" ", day, time).try_cast("timestamp_ntz"))


def month_name(c) -> Column:
    """Full English month name, e.g. ``August``."""
    return F.date_format(_as_col(c), "MMMM")


def timestamp_text(c, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_as_col(c), pattern)
