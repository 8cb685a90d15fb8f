from pyspark.sql import functions as F

from quayside.functions.codecs import resolve_codec, resolve_codec_py
from quayside.functions.naming import to_camel, to_snake
from quayside.functions.text import decode_value, fill_template, record_status, trim_to_empty, utf16_length
from quayside.functions.timefmt import iso_utc, pattern_ok, pattern_problem


def _one(spark, col, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_to_snake(spark):
    data = [("MyName",), ("HTTPServer",), ("already_snake",), ("aBcD",), ("",), (None,), ("  ",), ("ÉtéX",)]
    assert _one(spark, to_snake("s"), data) == [
        "my_name", "httpserver", "already_snake", "a_bc_d", "", None, "  ", "Étéx"]


def test_to_camel(spark):
    data = [("my_name",), ("_lead_x",), ("a__b",), ("tail_",), ("plain",), ("",), (None,)]
    assert _one(spark, to_camel("s"), data) == ["myName", "LeadX", "aB", "tail", "plain", "", None]


def test_trim_to_empty_java_rules(spark):
    data = [(None,), ("\t x \n",), ("",)]
    assert _one(spark, trim_to_empty("s"), data) == ["", "x", ""]


def test_fill_template(spark):
    df = spark.createDataFrame([("a", " 2 ", None), ("NULL", "null ", "x")], "a string, b string, c string")
    out = [r[0] for r in df.select(fill_template("{0}-{1}-{2}-{0}", "a", "b", "c")).collect()]
    assert out == ["a-2--a", "--x-"]
    blank = df.select(fill_template("  ", "a")).first()[0]
    assert blank == ""


def test_iso_utc(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 05:06:07.123999' AS t")
    assert df.select(iso_utc("t")).first()[0] == "2024-01-01T05:06:07.123Z"


def test_codec_resolution(spark):
    names = ["gzip", "GZIP", "GzipCodec", "org.apache.hadoop.io.compress.GzipCodec", "bzip2",
             "BZip2Codec", "snappy", "Lz4", "default", "deflate", "None", None, "lzo", "zstd"]
    got = _one(spark, resolve_codec("s"), [(n,) for n in names])
    assert got == ["gzip", "gzip", "gzip", "gzip", "bzip2", "bzip2", "snappy", "lz4", "deflate", "deflate",
                   None, None, "?", "?"]
    assert resolve_codec_py("GzipCodec") == "gzip"
    assert resolve_codec_py("None") is None
    import pytest

    with pytest.raises(ValueError):
        resolve_codec_py("lzo")


def test_pattern_checks(spark):
    pats = ["yyyy-MM-dd", "yyyyMMddHH", "yyyy/MM/dd", "YYYY-MM-dd", "uuuu", "yy-M-d", "yyyy'week'", "EEE"]
    assert [pattern_problem(p) is None for p in pats] == [True, True, True, False, False, True, True, True]
    assert _one(spark, pattern_ok("s"), [(p,) for p in pats]) == [True, True, True, False, False, True, True, True]


def test_decode_and_status(spark):
    df = spark.createDataFrame([(b"ok",), (None,), (bytes([0x41, 0xFF]),), (b"",), ("a\nb".encode(),)],
                               "v binary")
    out = df.select(decode_value("v"), record_status("v")).collect()
    assert [tuple(r) for r in out] == [("ok", "ok"), (None, "null_value"), (None, "bad_utf8"), ("", "ok"),
                                       ("a\nb", "ok")]


def test_utf16_length_beyond_bmp(spark):
    df = spark.createDataFrame([("a😀b",), ("abc",), ("",)], "s string")
    assert [r[0] for r in df.select(utf16_length("s")).collect()] == [4, 3, 0]
    assert [r[0] for r in df.select(F.length("s")).collect()] == [3, 3, 0]


def test_first_failure_and_try_int(spark):
    from quayside.functions.coerce import allowed_value, first_failure, try_int

    df = spark.createDataFrame([("1-URGENT", "F"), ("x-HIGH", "O"), ("2-SOON", "O"), ("3-LOW", "Q"), (None, "F")],
                               "p string, s string")
    rank = try_int(F.split_part("p", F.lit("-"), F.lit(1)))
    reason = first_failure([(rank.isNotNull(), "nan"),
                            (allowed_value(F.split_part("p", F.lit("-"), F.lit(2)), ["URGENT", "HIGH", "LOW"]),
                             "enum"),
                            (allowed_value("s", ["F", "O"]), "status")])
    assert [r[0] for r in df.select(reason).collect()] == [None, "nan", "enum", "status", "nan"]


def _snake_spec(s):
    if s is None or s.strip() == "":
        return s
    out = []
    for i, ch in enumerate(s):
        prev = s[i - 1] if i else ""
        if "A" <= ch <= "Z" and "a" <= prev <= "z":
            out.append("_")
        out.append(ch.lower() if "A" <= ch <= "Z" else ch)
    return "".join(out)


def _camel_spec(s):
    if s is None or s.strip() == "":
        return s
    out = []
    for i, ch in enumerate(s):
        prev = s[i - 1] if i else ""
        if ch == "_":
            continue
        out.append(ch.upper() if prev == "_" and "a" <= ch <= "z" else ch)
    return "".join(out)


def test_naming_against_spec(spark):
    import random

    rnd = random.Random(11)
    alphabet = "aBcDxYz_ _9É"
    words = [None, "", "   "] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12)))
                                  for _ in range(400)]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = df.select("s", to_snake("s").alias("sn"), to_camel("s").alias("cm")).collect()
    for r in got:
        assert r.sn == _snake_spec(r.s), r.s
        assert r.cm == _camel_spec(r.s), r.s


def test_cli_argument_checks():
    import pytest

    from quayside.__main__ import main

    with pytest.raises(SystemExit):  # a record source is required
        main(["land", "--feeds-parquet", "/x", "--out", "/o", "--checkpoint", "/c"])
    with pytest.raises(SystemExit):  # compaction needs a manifest or a folder
        main(["compact", "--out", "/o"])
    with pytest.raises(SystemExit):  # a feed source is required
        main(["land", "--replay", "/r", "--out", "/o", "--checkpoint", "/c"])
