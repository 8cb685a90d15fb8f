"""WARC archives: written from pages with identical-payload revisits, read
back in parallel by boundary-chain verification.

**Writing.** Payload digests of at least ``min_dedup`` bytes that occur more
than once form a table with the page that stays a full ``response`` (the
largest page_id); every other page with that digest becomes a ``revisit``
record: headers only, pointing at it.  The table is written first, so the
join with the pages is planned by its real size (broadcast when it is small,
else a shuffle).  Each task writes its pages to files of its own.

**Reading.** A file is cut into byte ranges.  The text ``WARC/1.1`` may well
stand inside a payload, so a match proves nothing.  Instead:

1. every range task parses each match that it finds as a record header and
   notes where that record would end, which is where its successor starts.
   Successors inside the range are followed on the spot, so what a candidate
   yields is the first offset behind the range (``leaves``);
2. the candidates at which some chain enters a range, and the start of the
   file, are the nodes of a linked list; pointer jumping from offset 0
   (each round doubles the ranges that a jump spans) keeps those that are
   reached;
3. range tasks follow the chain from their verified entry and give the
   records.  A match inside a payload is on no chain from the file's start.

Nulls and the like: a null html is an empty payload, a null url gives no
Target-URI, a null page_id is below any other (and stays null).  Of rows
with equal page_id and payload each is written.  No pages: no files, no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import urllib.parse
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import committed_file, input_file

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
HEAD_END = b"\r\n\r\n"
RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 1 << 30       # bytes after which a task starts another file
RANGE_BYTES = 16 << 20     # bytes of a reading task's range
HEAD_BYTES = 1 << 20       # bytes read on at first where a header's end isn't in the range; then more and more
MOST_BYTES = 64 << 20      # and at most at once
NAME_BYTES = 1 << 10       # a header's line has its colon within so many bytes
BATCH_BYTES = 8 << 20      # payload bytes in a batch of read records

FILES = "path string, n_bytes bigint, n_records bigint"
RECORDS = ("path string, offset bigint, warc_type string, target_uri string, page_id bigint, refers_to bigint, "
           "payload_digest string, payload_bytes bigint, payload binary")


def _uri(url: str) -> str:
    """A url that is safe on a header line."""
    return urllib.parse.quote(url, safe="".join(map(chr, range(33, 127))))


def _record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *fields, ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    return MAGIC + head.encode() + b"\r\n" + block + RECORD_END


def page_record(page_id, url, payload: bytes, digest: str, refers_to, refers_uri, unique: str, date: str) -> bytes:
    """One response record, or a revisit when ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, unique)}>"), ("WARC-Date", date),
              ("WARC-Target-URI", None if url is None else _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Profile", REVISIT_PROFILE if revisit else None),
              ("WARC-Refers-To-Target-URI", None if refers_uri is None else _uri(refers_uri)),
              ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", refers_to), ("Content-Type", "application/http;msgtype=response")]
    return _record("revisit" if revisit else "response", fields, http if revisit else http + payload)


def write_warc(pages: DataFrame, out: str, min_dedup: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives under ``out``;
    returns the files: path, n_bytes, n_records."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
            .withColumn("digest", F.sha1("payload")))
    (rows.filter(F.length("payload") >= min_dedup).groupBy("digest")
     .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("kept")).filter("n > 1")
     .select("digest", F.col("kept.page_id").alias("refers_to"), F.col("kept.url").alias("refers_uri"))
     .write.mode("overwrite").parquet(f"{out}/_repeated"))
    repeated = spark.read.parquet(f"{out}/_repeated").filter("refers_to IS NOT NULL")
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    told = (rows.join(repeated, "digest", "left")
            .select("page_id", "url", "payload", "digest", F.when(other, F.col("refers_to")).alias("refers_to"),
                    F.when(other, F.col("refers_uri")).alias("refers_uri")))

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0

        def records():
            for batch in batches:
                yield from zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "refers_uri")))

        todo = records()
        row = next(todo, None)
        while row is not None:
            path, size, n = f"{out}/part-{part:06d}-{seq:04d}.warc", 0, 0
            with committed_file(path) as f:
                while row is not None and size < FILE_BYTES:
                    page_id, url, data, digest, refers_to, refers_uri = (x.as_py() for x in row)
                    record = page_record(page_id, url, data, digest, refers_to, refers_uri, f"{part}-{seq}-{n}", date)
                    f.write(record)
                    size, n, row = size + len(record), n + 1, next(todo, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "n_bytes": [size], "n_records": [n]})
            seq += 1

    told.mapInArrow(write, FILES).write.mode("overwrite").parquet(f"{out}/_files")
    return spark.read.schema(FILES).parquet(f"{out}/_files")


class _Range:
    """Bytes of a file from ``lo`` on, fetched as they are asked for."""

    def __init__(self, f, lo: int, hi: int):
        self.f, self.lo, self.size = f, lo, f.size()
        f.seek(lo)
        self.data = f.read(min(hi + len(MAGIC), self.size) - lo)
        self.ends = 0, -1       # no HEAD_END stands between the first and the second
        self.lines = -1, -1, -1, None       # of the header end looked at last: see _lines_before

    def head_end(self, at: int) -> int:
        """Offset of the first ``HEAD_END`` at or behind ``at``; the file's
        size if there is none."""
        if not self.ends[0] <= at <= self.ends[1]:
            found = self.data.find(HEAD_END, at - self.lo)
            self.ends = at, self.lo + found if found >= 0 else self._later_end(max(at, self.lo + len(self.data) - len(HEAD_END) + 1))
        return self.ends[1]

    def _later_end(self, at: int) -> int:
        step = HEAD_BYTES
        while at + len(HEAD_END) <= self.size:
            self.f.seek(at)
            more = self.f.read(step)
            if (found := more.find(HEAD_END)) >= 0:
                return at + found
            at, step = at + len(more) - len(HEAD_END) + 1, min(2 * step, MOST_BYTES)
        return self.size

    def head(self, at: int) -> tuple[dict[str, str], int] | None:
        """(fields, offset of the block) if a well-formed header stands at ``at``."""
        # What has no field names is no header, however far its end may be.
        a = at - self.lo
        end = self.data.find(HEAD_END, a, a + HEAD_BYTES)
        lines = self.data[a:end if end >= 0 else a + HEAD_BYTES].split(b"\r\n")
        if lines[0] != MAGIC[:-2] or any(b":" not in x for x in lines[1:-1]) or (len(lines[-1]) > NAME_BYTES and b":" not in lines[-1][:NAME_BYTES]):
            return None
        if (end := self.head_end(at)) == self.size:
            return None
        fields = {}
        for line in self.block(at, end).decode("utf-8", "replace").split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if not colon:
                return None
            fields[name.strip().lower()] = value.strip()
        return fields, end + len(HEAD_END)

    def record(self, at: int) -> tuple[dict[str, str], int, int] | None:
        """(fields, block from, block to); None if no record can stand here."""
        if not (got := self.head(at)):
            return None
        fields, block = got
        if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
            return None
        to = block + int(fields["content-length"])
        return (fields, block, to) if to + len(RECORD_END) <= self.size else None

    def successor(self, at: int) -> int | None:
        """Where the record behind the one at ``at`` would stand; None if none
        can stand at ``at``.  Asked for ascending offsets, every byte is looked
        at once: what the lines before a header's end say holds for all
        headers that end there."""
        a = at - self.lo + len(MAGIC)
        line, more, _ = self.data[a:a + NAME_BYTES].partition(b"\r\n")
        if b":" not in line and (more or len(line) == NAME_BYTES):
            return None         # no field name, however far the header's end may be
        if (end := self.head_end(at)) == self.size:
            return None
        if self.lines[0] != end:
            self.lines = end, *self._lines_before(at, end)
        _, broken, where, length = self.lines
        if broken > at or where <= at or length is None:
            return None
        to = end + len(HEAD_END) + length + len(RECORD_END)
        return to if to <= self.size else None

    def _lines_before(self, lo: int, end: int) -> tuple[int, int, int | None]:
        """Of the lines from ``lo`` to ``end``: offset of the last without a
        colon, offset of the last Content-Length behind it (-1: none), and its
        number (None: not one)."""
        where, length, at = -1, None, end
        for line in reversed(self.block(lo, end).split(b"\r\n")):
            at -= len(line)
            name, colon, value = line.partition(b":")
            if not colon:
                return at, where, length
            if where < 0 and name.strip().lower() == b"content-length":
                where, length = at, int(value) if re.fullmatch(rb"\s*[0-9]{1,18}\s*", value) else None
            at -= 2
        return -1, where, length

    def block(self, lo: int, hi: int) -> bytes:
        if hi <= self.lo + len(self.data):
            return self.data[lo - self.lo:hi - self.lo]
        self.f.seek(lo)
        return self.f.read(hi - lo)


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """path, lo, hi: the byte ranges of the files."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("n_bytes") - 1, F.lit(range_bytes).cast("bigint"))
    return (files.filter("n_bytes > 0").select("path", "n_bytes", F.explode(starts).alias("lo"))
            .select("path", "lo", F.least(F.col("lo") + range_bytes, F.col("n_bytes")).alias("hi")))


def _candidates(batches):
    """Every match that parses as a record: where its chain leaves the range."""
    import pyarrow as pa

    for batch in batches:
        for path, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "hi"))):
            with input_file(path) as f:
                r, found = _Range(f, lo, hi), []
                at = r.data.find(MAGIC)
                while 0 <= at < hi - lo:
                    if after := r.successor(lo + at):
                        found.append((lo + at, after))
                    at = r.data.find(MAGIC, at + 1)
            leaves: dict[int, tuple[int, int]] = {}
            for at, after in reversed(found):
                if after >= hi:
                    leaves[at] = after, 1
                elif after in leaves:
                    leaves[at] = leaves[after][0], leaves[after][1] + 1
            n = len(leaves)
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path] * n, pa.string()), "offset": pa.array(leaves, pa.int64()),
                "leaves": pa.array([x for x, _ in leaves.values()], pa.int64()), "hi": pa.array([hi] * n, pa.int64()),
                "records": pa.array([x for _, x in leaves.values()], pa.int64())})


def chain_entries(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, offset, hi: for each byte range that the true chain enters, the
    first record of it.  A chain that doesn't lead from a file's start to its
    end, or has another number of records than the file, is an error."""
    spark = files.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = files.agg(F.max("n_bytes")).first()[0] or 0
    candidates = _ranges(files, range_bytes).repartition(tasks).mapInArrow(_candidates, "path string, offset bigint, leaves bigint, hi bigint, records bigint").checkpoint()
    enters = candidates.select("path", F.col("leaves").alias("offset")).distinct()
    nodes = (candidates.join(enters, ["path", "offset"], "left_semi")
             .unionByName(candidates.filter("offset = 0")).distinct().checkpoint())
    jump = nodes.select("path", "offset", "leaves")
    reached = nodes.filter("offset = 0").select("path", "offset")
    for k in range(math.ceil(math.log2(max(1, most / range_bytes) + 1))):
        if k:
            far = jump.select("path", F.col("offset").alias("leaves"), F.col("leaves").alias("farther"))
            jump = jump.join(far, ["path", "leaves"]).select("path", "offset", F.col("farther").alias("leaves")).checkpoint()
        reached = (reached.join(jump, ["path", "offset"]).select("path", F.col("leaves").alias("offset"))
                   .unionByName(reached).distinct().checkpoint())
    chain = nodes.join(reached, ["path", "offset"], "left_semi").checkpoint()
    ends = chain.groupBy("path").agg(F.max("leaves").alias("ends"), F.sum("records").alias("records"))
    whole = F.col("ends").eqNullSafe(F.col("n_bytes")) & F.col("records").eqNullSafe(F.col("n_records"))
    if broken := files.filter("n_bytes > 0").join(ends, "path", "left").filter(~whole).select("path", "n_bytes", "n_records", "ends", "records").take(3):
        raise ValueError(f"the records of an archive don't lead to its end, or aren't as many as were written: {broken}")
    return chain.select("path", "offset", "hi")


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """The page records of the archives: path, offset, warc_type, target_uri,
    page_id, refers_to (page_id), payload_digest (hex SHA-1; of a response
    computed from the bytes and checked), payload_bytes (of the full payload)
    and payload (null for revisits, or when not asked for)."""
    def read(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        rows, held = [], 0
        batched = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)
        for batch in batches:
            for path, at, hi in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "hi"))):
                with input_file(path) as f:
                    r = _Range(f, at, hi)
                    while at < hi:
                        if not (got := r.record(at)):
                            raise ValueError(f"{path}: no record at {at}")
                        fields, lo, to = got
                        rows.append((path, at, *_page(fields, r.block(lo, to), with_payload)))
                        at, held = to + len(RECORD_END), held + (to - lo if with_payload else 200)
                        if held > BATCH_BYTES:
                            yield batched()
                            rows, held = [], 0
        yield batched()

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chain_entries(files, range_bytes).repartition(tasks).mapInArrow(read, RECORDS)


def _page(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """Columns of a page's record from its fields and block."""
    number = lambda name: int(fields[name]) if name in fields else None
    head, _, payload = block.partition(HEAD_END)
    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    full = fields["warc-type"] == "response"
    if full and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its length or digest")
    return fields["warc-type"], fields.get("warc-target-uri"), number("x-page-id"), number("x-refers-to-page-id"), digest, size, payload if full and with_payload else None
