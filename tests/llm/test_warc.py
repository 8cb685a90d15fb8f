import hashlib
import random

import pytest
from helpers import with_clashes

from quayside.llm import warc
from quayside.session import scratch_path

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages():
    rng = random.Random(4)
    big = "x" * 1500
    rows = [(i, f"http://h{i}.org/a b\r\nc", "".join(rng.choice("abc \n") for _ in range(rng.randrange(0, 4000)))) for i in range(60)]
    rows += [(100 + i, "u", big) for i in range(20)] + [(200 + i, "u", "x" * 999) for i in range(3)]
    rows += [(300, None, None), (301, "", ""), (302, "é", FAKE * 40), (303, "u", "WARC/1.1\r\n" * 300), (304, "u", FAKE[:30] + "\r\n\r\n"), (305, "u", "ü\u2028😀" * 800)]
    return rows + [(None, "u", big), (None, "v", "short"), (307, "u", "twice"), (307, "u", "twice"), (308, "u", "y" * 2000), (308, "u", "y" * 2000), (309, "w", "z" * 300_000)]


def want(rows):
    out = []
    data = [(i, (h or "").encode()) for i, _, h in rows]
    for i, d in data:
        same = [j for j, e in data if e == d and j is not None] if len(d) >= 1000 else []
        refers = max(same) if same and i != max(same) else None
        out.append((-1 if i is None else i, len(d), hashlib.sha1(d).hexdigest(), "response" if refers is None else "revisit", -1 if refers is None else refers))
    return sorted(out)


def test_round_trip_rejects_magic_in_payloads(spark):
    rows = pages()
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)
    files = warc.write_warc(df, scratch_path(spark, "w"))
    by_id = {}
    for i, _, h in rows:
        by_id.setdefault(i, set()).add((h or "").encode())
    for size in (300, 5000, 1 << 24):
        got = warc.read_warc(files, range_bytes=size).collect()
        assert sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in got) == want(rows)
        assert all((r["payload"] is None) if r["warc_type"] == "revisit" else bytes(r["payload"]) in by_id[r["page_id"]] for r in got)


def test_several_files_a_task(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rows = pages()
    files = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), scratch_path(spark, "w"))
    assert files.count() > 5
    assert warc.read_warc(files, with_payload=False).count() == len(rows)


def test_no_pages(spark):
    files = warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), scratch_path(spark, "w"))
    assert warc.read_warc(files).collect() == []


def test_headers_of_any_length(spark):
    """Urls of more bytes than the reader takes at once: alone, before and behind others, in a revisit."""
    long, body = "http://h.org/" + "é" * 400_000, "x" * 1500
    rows = [(1, "u", "one"), (2, long, "two" + FAKE), (3, long, body), (4, long, body), (5, "u", "WARC/1.1\r\n" * 3000), (6, "u", "WARC/1.1\r\n" + "y" * 3000)]
    files = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), scratch_path(spark, "w"))
    assert files.first()["n_bytes"] > 5 * warc.HEAD_BYTES
    for size in (5000, 1 << 24):
        got = warc.read_warc(files, range_bytes=size).collect()
        assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in got) == want(rows)
        assert {len(r["target_uri"]) for r in got if r["page_id"] in (2, 3, 4)} == {13 + 6 * 400_000}


def test_a_broken_archive_is_an_error(spark):
    files = warc.write_warc(spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(1), scratch_path(spark, "w"))
    for wrong in (files.withColumn("n_records", files["n_records"] + 1), files.withColumn("n_bytes", files["n_bytes"] - 10)):
        with pytest.raises(ValueError):
            warc.read_warc(wrong, range_bytes=5000).collect()


@pytest.mark.parametrize("line", ["WARC/1.1\r\nA: b\r\n", "A: WARC/1.1\r\n", "WARC/1.1\r\n", "WARC/1.1\r\nContent-Length: 1\r\n", "WARC/1.1\r\n" + "x" * 1000 + "\r\n"])
def test_dense_magic_is_read_in_linear_time(spark, line):
    """16 MB of a payload that looks like headers: every byte is looked at a few times."""
    import time

    body = line * ((16 << 20) // len(line))
    rows = [(1, "u", "one"), (2, "u", body), (3, "u", body + "\r\n\r\n"), (4, "u", "four")]
    files = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), scratch_path(spark, "w"))
    began = time.monotonic()
    got = warc.read_warc(files, with_payload=False).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["warc_type"], -1) for r in got) == want(rows)
    assert time.monotonic() - began < 90


@pytest.mark.parametrize("seed", range(4))
def test_successors_are_those_of_parsed_records(tmp_path, seed):
    """The quick look at any bytes says what parsing the header says."""
    from quayside.llm.storage import input_file

    rng = random.Random(seed)
    parts = [b"WARC/1.1\r\n", b"\r\n", b"\r\n\r\n", b"A: b", b"Content-Length: 7", b"Content-Length: 7\r\n\r\n", b"content-length : 3 ", b"Content-Length: x", b"no colon", b"x:WARC/1.1\r\n", b"y" * 30]
    data = b"".join(rng.choice(parts) + (b"\r\n" if rng.random() < .5 else b"") for _ in range(6000))
    (tmp_path / "w").write_bytes(data)
    with input_file(str(tmp_path / "w")) as f:
        r, at, n = warc._Range(f, 0, len(data)), data.find(warc.MAGIC), 0
        while at >= 0:
            parsed = warc._Range(f, at, len(data)).record(at)
            assert r.successor(at) == (parsed[2] + 4 if parsed else None), at
            at, n = data.find(warc.MAGIC, at + 1), n + bool(parsed)
        assert n
