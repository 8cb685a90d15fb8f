"""Text helpers: decoding, line framing, Java-style trim and templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() strips every char <= U+0020 at both ends.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"

LINE_BREAK = "\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_value(value="value") -> Column:
    """Bytes -> UTF-8 text; invalid bytes give null (sent to dead letter)."""
    return F.try_validate_utf8(_col(value).cast("string"))


def record_status(value="value") -> Column:
    """``ok`` / ``null_value`` / ``bad_utf8`` for a raw record value."""
    v = _col(value)
    return (F.when(v.isNull(), F.lit("null_value"))
            .when(decode_value(v).isNull(), F.lit("bad_utf8"))
            .otherwise(F.lit("ok")))


def frame_line(text, line_breaks) -> Column:
    """Append a line break iff the feed asks for one (flag == 1)."""
    flag = F.lit(line_breaks) if isinstance(line_breaks, (int, bool)) else _col(line_breaks)
    return F.when(flag == 1, F.concat(_col(text), F.lit(LINE_BREAK))).otherwise(_col(text))


def utf16_length(c) -> Column:
    """Length in UTF-16 code units, as Java's ``String.length()`` counts."""
    return (F.octet_length(F.encode(_col(c), "UTF-16BE")) / 2).cast("bigint")


def trim_to_empty(c) -> Column:
    """null -> '' else Java-trimmed text."""
    return F.coalesce(F.regexp_replace(_col(c), _JAVA_TRIM, ""), F.lit(""))


def fill_template(template, *args) -> Column:
    """Replace ``{i}`` with the trimmed i-th argument; a null argument or one
    whose trimmed text is ``null`` (any case) becomes ''. A blank template
    gives ''."""
    tpl = F.lit(template) if isinstance(template, str) else template
    out = tpl
    for i, a in enumerate(args):
        a = _col(a) if isinstance(a, (str, Column)) else F.lit(a)
        t = trim_to_empty(a.cast("string"))
        t = F.when(F.lower(t) == "null", F.lit("")).otherwise(t)
        out = F.replace(out, F.lit("{%d}" % i), t)
    blank = tpl.isNull() | (F.regexp_replace(tpl, r"^\s+$", "") == "")
    return F.when(blank, F.lit("")).otherwise(out)
