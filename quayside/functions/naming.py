"""Column-name style conversion as column expressions (no Python UDF).

``to_snake``: put ``_`` before an ASCII capital that follows an ASCII small
letter, then lower ASCII capitals (``MyName`` -> ``my_name``,
``HTTPServer`` -> ``httpserver``).
``to_camel``: drop every ``_`` and upper the ASCII letter after it
(``my_name`` -> ``myName``, ``_lead_x`` -> ``LeadX``, ``a__b`` -> ``aB``).
Blank input (null, empty or all white space) is returned unchanged.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = string.ascii_uppercase
_LOWER = string.ascii_lowercase


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (F.regexp_replace(c, r"^\s+$", "") == "")


def to_snake(c) -> Column:
    c = _col(c)
    snake = F.translate(F.regexp_replace(c, "([a-z])([A-Z])", "$1_$2"), _UPPER, _LOWER)
    return F.when(is_blank(c), c).otherwise(snake)


def to_camel(c) -> Column:
    c = _col(c)
    parts = F.split(c, "_", -1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    cap = F.transform(rest, lambda p: F.concat(F.translate(F.substring(p, 1, 1), _LOWER, _UPPER),
                                              F.substring(p, 2, 1 << 30)))
    camel = F.concat(F.element_at(parts, 1), F.array_join(cap, ""))
    return F.when(is_blank(c), c).otherwise(camel)
