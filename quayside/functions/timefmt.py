"""Date/time formatting for bucket paths and ISO stamps."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ISO stamp, the default date pattern of a path, the hour of a path.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DEFAULT_PATH_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"

# Pattern letters that mean the same in the old formatter and in Spark.
_SAFE_LETTERS = set("GyMdHhmsSEaDkKz")
# Letters Spark rejects or reads differently (week-year, day-of-week number).
_BAD_LETTERS = set("YuwWFecL")
# Regex class of every ASCII letter outside the safe set.
BAD_LETTER_CLASS = "[" + "".join(sorted(set(string.ascii_letters) - _SAFE_LETTERS)) + "]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_date(clock, fmt=DEFAULT_PATH_FORMAT) -> Column:
    if isinstance(fmt, str):
        return F.date_format(_col(clock), fmt)
    return F.call_function("date_format", _col(clock), fmt)


def hour_of(clock) -> Column:
    return F.date_format(_col(clock), HOUR_FORMAT)


def iso_utc(clock) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'``; the session zone must be UTC."""
    return F.date_format(_col(clock), ISO_UTC)


def pattern_problem(fmt: str | None) -> str | None:
    """Why a path pattern cannot be used, or None when it is fine."""
    if fmt is None or fmt == "":
        return "empty pattern"
    bare = re.sub(r"'[^']*'", "", fmt)
    for ch in bare:
        if ch.isascii() and ch.isalpha():
            if ch in _BAD_LETTERS:
                return f"pattern letter {ch!r} is not supported"
            if ch not in _SAFE_LETTERS:
                return f"unknown pattern letter {ch!r}"
    return None


def pattern_ok(fmt) -> Column:
    """Column form of ``pattern_problem`` (True when usable)."""
    c = _col(fmt)
    bare = F.regexp_replace(c, "'[^']*'", "")
    bad = F.regexp_like(bare, F.lit(BAD_LETTER_CLASS))
    return c.isNotNull() & (c != "") & ~bad
