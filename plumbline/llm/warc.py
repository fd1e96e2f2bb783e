"""WARC archives of pages, read back into one globally ordered capture index.

Writing: each page becomes one record, built by column expressions; pages with
equal payloads are one response and its revisits.  Spark's text writer puts the
records, closed by the blank lines the format asks for, into gzip archives.

Reading: each archive is one run.  Its captures are sorted where they are
parsed; the runs meet by ranges of (url key, time, page id), and every range
merges its parts of the runs by a loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import kept
from plumbline.session import shared_folder

#: every WARC record ends with two empty lines
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: captures have no time in the input: second n of this day on stands for page n
FIRST_SECOND = 1577836800
#: bounds an archive, which is parsed by one task
RECORDS_PER_ARCHIVE = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " url string, url_key string, captured_at long, archive string, place long"
)
CAPTURE_NAMES = [c.split()[0] for c in CAPTURE_SCHEMA.split(", ")]


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: five hex digits are four letters."""
    letters = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(hex_digest, at, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def typed(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` with ``digest``, ``size``, ``record_type`` and ``refers_to``.

    Of equal payloads the one with the largest id is the response.  Repeated
    rows of that id are responses each; rows with a null id refer to it like
    others, and if all ids are null all rows are responses.  Null html is empty.
    """
    html = F.coalesce("html", F.lit(""))
    payload = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    shared = payload.groupBy("digest").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    joined = payload.join(shared.drop("_n"), "digest", "left")
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return joined.select(
        "page_id",
        "url",
        "html",
        base32(F.col("digest")).alias("digest"),
        F.octet_length("html").cast("long").alias("size"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_last")).alias("refers_to"),
    )


def records(pages: DataFrame) -> DataFrame:
    """One column ``value``: the record of each row of ``typed``, without its end."""
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7f]", "%20")
    response = F.col("record_type") == "response"
    stamp = F.date_format(F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + FIRST_SECOND), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.when(response, F.concat(head, F.col("html"))).otherwise(head)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return pages.select(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            line("WARC-Type", F.col("record_type")),
            line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(">"))),
            line("WARC-Date", stamp),
            line("WARC-Target-URI", uri),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(response, F.lit("")).otherwise(
                F.concat(
                    line("WARC-Profile", F.lit(PROFILE)),
                    line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
                )
            ),
            F.lit("Content-Type: application/http; msgtype=response\r\n"),
            line("Content-Length", F.octet_length(block).cast("string")),
            F.lit("\r\n"),
            block,
        ).alias("value")
    )


def write(pages: DataFrame, folder: str) -> None:
    """Gzip archives of all rows of ``pages`` in ``folder``."""
    out = records(typed(pages)).write.option("lineSep", RECORD_END).option("compression", "gzip")
    out.option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(folder)


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of one archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def _id(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def url_key(url: str) -> str:
    """Sort key of a url: host labels from the top, then path and query, in lower case."""
    host, slash, path = url.partition("://")[2].partition("/")
    return ",".join(reversed(host.lower().split(":")[0].split("."))) + ")" + slash + path.partition("#")[0].lower()


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive's captures as one run, sorted by key, ``place`` counting from 0."""
    for batch in batches:
        for i in range(batch.num_rows):
            path = batch["path"][i].as_py()
            run = []
            with gzip.GzipFile(fileobj=io.BytesIO(batch["content"][i].as_buffer())) as raw:
                for fields, block in parsed(io.BufferedReader(raw)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(head.rpartition(b"Content-Length: ")[2])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and (
                        len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
                    ):
                        raise ValueError(f"payload of {fields['warc-record-id']} in {path} is damaged")
                    page, url = _id(fields["warc-record-id"]), fields["warc-target-uri"]
                    refers = _id(fields["warc-refers-to"]) if kind == "revisit" else None
                    run.append((page, length, digest, kind, refers, url, url_key(url), (page or 0) + FIRST_SECOND, path))
            run.sort(key=_key)
            columns = list(zip(*[(*r, k) for k, r in enumerate(run)], strict=True)) or [[]] * len(CAPTURE_NAMES)
            yield pa.RecordBatch.from_pydict(dict(zip(CAPTURE_NAMES, columns, strict=True)), schema=_ARROW)


_ARROW = pa.schema(
    [(n, pa.string() if n in ("payload_digest", "record_type", "url", "url_key", "archive") else pa.int64()) for n in CAPTURE_NAMES]
)


def _key(row: tuple) -> tuple:
    return row[6], row[7], -1 if row[0] is None else row[0], row[8]


class LoserTree:
    """Merges sorted iterators; each node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[Iterator[tuple]], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i, building=True)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[:2] <= y[:2])

    def _play(self, i: int, building: bool = False) -> None:
        node = (i + self.k) // 2
        while node:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = i
                return
            if other >= 0 and self._beats(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while self.k and (head := self.heads[i := self.losers[0]]) is not None:
            yield head[2]
            self.heads[i] = self._next(i)
            self._play(i)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: its parts of the runs, each in its own order, merged."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            runs.setdefault(row[8], []).append(row)
    for rows in runs.values():
        rows.sort(key=lambda r: r[9])
    merged = list(LoserTree([iter(runs[name]) for name in sorted(runs)], _key))
    if merged:
        yield pa.RecordBatch.from_pydict(dict(zip(CAPTURE_NAMES, zip(*merged, strict=True), strict=True)), schema=_ARROW)


def capture_index(spark, folder: str) -> DataFrame:
    """Captures of all archives in ``folder``, in the order of url key, time and page id.

    Ranges are cut by the whole key, so a site or url with a third of all
    captures is spread over several of them.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    runs = kept(files.mapInArrow(_captures, CAPTURE_SCHEMA), "captures")
    return runs.repartitionByRange("url_key", "captured_at", "page_id").mapInArrow(_merge, CAPTURE_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back as the capture index.

    One capture for every row, repeated rows included; an empty table writes an
    empty archive.  Only ``page_id``, ``url`` and ``html`` are read.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid4().hex}"
    write(pages, folder)
    return capture_index(spark, folder)
