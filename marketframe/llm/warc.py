"""WARC archives: writing with revisit records, reading back, and one globally ordered capture index.

Writing: each page is a record, its payload the html in UTF-8. Records are composed by DataFrame functions and written by Spark's text writer (the
two empty lines that end a WARC record are the line separator), so archives go wherever Spark can write: gzip files of at most
``records_per_file`` records and ``bytes_per_file`` bytes. Of records with equal payloads of at least ``min_bytes`` bytes, that of the
largest id is the response and the others revisit it, without payload. Whether payloads are equal is decided on their digests; only digests that occur
twice meet the pages again. Each file is written in order of URL key and time: a locally sorted run.

Reading: files come through Spark's binary reader and are decompressed and parsed in small steps; each payload's digest and length
are checked against its headers. Merging: captures (no payloads) are dealt out by ranges of (URL key, time, id), and each task merges
its slices of the runs with a loser tree, so that the result is globally ordered: the partitions by range, each in order.

Defined cases: null html is an empty payload; a null URL has no target header and an empty URL key; a null id is written as an empty one and read as null, orders before
others and revisits the largest id if there is one; ids may be of any size, also negative. Repeated rows that share the largest id are all responses. Control characters in
URLs are percent-encoded. An empty table gives an empty index. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from base64 import b32encode
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
CAPTURE = "url_key string, ts string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, position long"
STEP = 1 << 20
#: Ids of any size give times within some thirty years.
SECONDS = 10**9


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight times twenty bits, from base 32 with digits to RFC 4648's alphabet."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Sort-friendly key: ``com,example,host)/path?query`` without scheme, ``www.``, port 80 or 443 and fragment."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#]*)", 1)), r"^www\.|:(?:80|443)$", "")
    rest = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^#]*)", 1)
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))), F.lit(""))


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, records_per_file: int = 5000, bytes_per_file: int = 256 << 20) -> None:
    """Writes the pages' records to ``path``. A page's time is 2024-01-01 and, in seconds, its id modulo ``SECONDS``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.select("id", "url", "payload", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("n"))
    same = rows.where(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("copies")).where((F.col("copies") > 1) & F.col("first").isNotNull()).select("digest", "first")
    rows = rows.join(same, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.col("n") >= min_bytes)
    when = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("id", F.lit(0)), F.lit(SECONDS)))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), r"\p{Cntrl}", "%7F")
    header = lambda key, value: F.concat(F.lit(f"\r\n{key}: "), value)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), header("WARC-Record-ID", name("id")),
        header("WARC-Date", F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.coalesce(header("WARC-Target-URI", uri), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), header("WARC-Refers-To", name("first")))).otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http;msgtype=response")), header("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block,
    )
    run = rows.select(url_key(uri).alias("k"), when.alias("w"), "id", record.alias("record")).sortWithinPartitions("k", "w", "id").select("record")
    # a file is read back whole: however long the records, one holds ``bytes_per_file`` at most, unless a single record is longer
    longest = pages.agg(F.max(F.octet_length(payload_col))).first()[0] or 0
    records_per_file = max(1, min(records_per_file, bytes_per_file // (longest + 4096)))
    run.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


class _Stream:
    """Bytes of a gzip file (of any number of members), decompressed in steps."""

    def __init__(self, content: memoryview):
        self.content, self.at, self.buffer, self.offset = content, 0, bytearray(), 0
        self.z = zlib.decompressobj(31)
        self.tail = b""

    def more(self) -> bool:
        data = self.tail
        if not data:
            data = bytes(self.content[self.at : self.at + STEP])
            self.at += len(data)
        if not data:
            return False
        self.buffer += self.z.decompress(data, 4 * STEP)
        self.tail = self.z.unconsumed_tail
        if self.z.eof:
            self.tail, self.z = self.z.unused_data, zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (i := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark))
            if not self.more():
                if self.buffer:
                    raise ValueError("the archive ends within a record's header")
                return None
        return self.take(i + len(mark))[: -len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.offset += n
        return out


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n")[1:])}


def _page(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(m[1]) if m else None


def records(content: memoryview) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers, block) of each record of an archive."""
    stream = _Stream(content)
    while True:
        at = stream.offset
        head = stream.until(END.encode())
        if head is None:
            return
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at {at}")
        headers = _headers(head)
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != END.encode():
            raise ValueError(f"the record at {at} is longer than it says")
        yield at, headers, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, checked against its headers: ``CAPTURE`` without url_key."""
    schema = CAPTURE.replace("url_key string, ", "")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = [_capture(path, *r) for r in records(memoryview(content.as_buffer()))]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(step, schema)


_ARROW = pa.schema([("ts", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("position", pa.int64())])


def _capture(path: str, at: int, headers: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(END.encode())
    size, kind = int(_headers(head)["content-length"]), headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{path}: the payload at {at} isn't what its headers say")
    return {"ts": re.sub("[^0-9]", "", headers["warc-date"]), "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": _page(headers.get("warc-refers-to")), "archive": path, "position": at}


class LoserTree:
    """Merges sorted sequences: inner nodes hold the loser of each match, so replacing the winner costs one match a level."""

    def __init__(self, runs: Sequence[Iterable], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = max(1, len(self.runs))
        self.head: list = [None] * self.k
        self.rank: list = [None] * self.k  # None: the run has ended
        for i in range(len(self.runs)):
            self._pull(i)
        self.loser = [-1] * self.k
        self.winner = self._play(1)

    def _pull(self, i: int) -> None:
        self.head[i] = next(self.runs[i], None)
        self.rank[i] = None if self.head[i] is None else (self.key(self.head[i]), i)

    def _beats(self, a: int, b: int) -> bool:
        return self.rank[b] is None or self.rank[a] is not None and self.rank[a] < self.rank[b]

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self._beats(b, a):
            a, b = b, a
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator:
        while self.rank[self.winner] is not None:
            i = self.winner
            yield self.head[i]
            self._pull(i)
            node = (i + self.k) // 2
            while node:
                if self._beats(self.loser[node], i):
                    self.loser[node], i = i, self.loser[node]
                node //= 2
            self.winner = i


def _order(row: dict) -> tuple:
    return row["url_key"], row["ts"], -1 << 63 if row["page_id"] is None else row["page_id"], row["archive"], row["position"]


def _rows(parts: Sequence[pa.RecordBatch]) -> Iterator[dict]:
    for batch in parts:
        for k in range(0, len(batch), 64):
            yield from batch.slice(k, 64).to_pylist()


def merge_index(captures: DataFrame) -> DataFrame:
    """Captures in global order of (url_key, ts, page_id): partitions by range, each a k-way merge of its runs' slices."""
    keyed = captures.withColumn("url_key", url_key(F.col("url"))).select([c.split()[0] for c in CAPTURE.split(", ")])
    # each run's slice comes in its own order: that of the archive
    dealt = keyed.repartitionByRange("url_key", "ts", "page_id").sortWithinPartitions("archive", "position")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # each run's slice stays in Arrow columns; the tree holds one row of each run, and a run's next rows are made few at a time
        slices: dict[str, list[pa.RecordBatch]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            if not len(batch):
                continue
            names = batch.column("archive").dictionary_encode()
            ends = [0, *(1 + i for i in pc.indices_nonzero(pc.not_equal(names.indices.slice(1), names.indices.slice(0, len(batch) - 1))).to_pylist()), len(batch)]
            for a, b in pairwise(ends):
                if b > a:
                    slices.setdefault(batch.column("archive")[a].as_py(), []).append(batch.slice(a, b - a))
        out: list[dict] = []
        for row in LoserTree([_rows(parts) for parts in slices.values()], _order):
            out.append(row)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return dealt.mapInArrow(step, CAPTURE)
