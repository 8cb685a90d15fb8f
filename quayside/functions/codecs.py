"""Codec lookup: the old class-name spellings -> Spark text-sink codecs."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codec classes a feed may name, the Spark text-sink codec each
# one maps to, and the extension it adds to a file's name.
CODEC_CLASSES = {
    "org.apache.hadoop.io.compress.BZip2Codec": "bzip2",
    "org.apache.hadoop.io.compress.DefaultCodec": "deflate",
    "org.apache.hadoop.io.compress.DeflateCodec": "deflate",
    "org.apache.hadoop.io.compress.GzipCodec": "gzip",
    "org.apache.hadoop.io.compress.Lz4Codec": "lz4",
    "org.apache.hadoop.io.compress.SnappyCodec": "snappy",
}
EXTENSIONS = {"gzip": ".gz", "bzip2": ".bz2", "deflate": ".deflate", "snappy": ".snappy", "lz4": ".lz4"}
NO_CODEC = "none"


def codec_spellings() -> dict[str, str]:
    """Case-insensitive names: simple class name and the name without
    ``Codec``, all lower-cased."""
    out = {}
    for cls, short in CODEC_CLASSES.items():
        simple = cls.rsplit(".", 1)[1]
        out[simple.lower()] = short
        if simple.endswith("Codec"):
            out[simple[: -len("Codec")].lower()] = short
    return out


def resolve_codec_py(name: str | None) -> str | None:
    """Python form: Spark codec name, ``none`` for 'None'/null, else raise."""
    if name is None or name.lower() == "none":
        return None
    if name in CODEC_CLASSES:
        return CODEC_CLASSES[name]
    hit = codec_spellings().get(name.lower())
    if hit is None:
        known = ", ".join(sorted(c.rsplit(".", 1)[1] for c in CODEC_CLASSES))
        raise ValueError(f"codec {name!r} is not one of: None, {known}")
    return hit


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(d.items()))])


def resolve_codec(name) -> Column:
    """Column form: Spark codec name; null for null/'None'; ``?`` when unknown."""
    c = F.col(name) if isinstance(name, str) else name
    hit = F.coalesce(F.element_at(_map(CODEC_CLASSES), c),
                     F.element_at(_map(codec_spellings()), F.lower(c)))
    return (F.when(c.isNull() | (F.lower(c) == NO_CODEC), F.lit(None).cast("string"))
            .otherwise(F.coalesce(hit, F.lit("?"))))


def codec_extension(codec) -> Column:
    """The extension of a codec's files; null without a codec."""
    c = F.col(codec) if isinstance(codec, str) else codec
    return F.element_at(_map(EXTENSIONS), c)
