"""WARC archives: written by Spark's own committed output, read back record by record.

An archive is a run of gzip members, one per record. Spark's text writer puts them down: every member
ends in a zero byte (the high byte of its length, for blocks below 16 MiB; an empty member follows a
longer one), and that byte is the writer's line separator. So the files are plain ``.warc.gz`` bytes
on whatever file system the cluster uses, committed like any other output of a job.

Reading is sequential: zlib inflates a few kilobytes at a time, the header is taken up to its empty
line, the block by its content length, and both digests are checked against what was inflated.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.shared import fields, map_rows, new_path, staged, utf8_bytes

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()

STEP = 1 << 16
"""Bytes inflated at a time."""
RECORDS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"

MEMBERS = fields("member binary")
RECORDS = fields(
    "path string, number long, record_type string, record_id string, refers_to string, uri string, "
    "date string, payload_bytes long, payload_digest string, payload binary, intact boolean"
)
NARROW = fields(
    "path string, number long, record_type string, record_id string, refers_to string, uri string, "
    "date string, payload_bytes long, payload_digest string, intact boolean"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(
    page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None, revisit: bool,
    date: str,
) -> bytes:
    """One record before compression: header lines, block, two line ends."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(page_id)),
        ("WARC-Date", date),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
    ]
    if uri is not None:
        lines.append(("WARC-Target-URI", " ".join(uri.split())))
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_name(refers_to))]
    lines += [("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in lines)
    return b"".join((VERSION, b"\r\n", head, b"\r\n", block, b"\r\n\r\n"))


def member(record: bytes) -> bytes:
    """A gzip member that ends in a zero byte."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = squeeze.compress(record) + squeeze.flush()
    return data if data[-1] == 0 else data + EMPTY_MEMBER


def _members(columns: dict, date: str) -> Iterator[tuple]:
    for page_id, uri, html, keeper, revisit in zip(
        columns["page_id"], columns["url"], columns["html"], columns["keeper"], columns["revisit"],
        strict=True,
    ):
        record = record_bytes(page_id, uri, (html or "").encode(), keeper, revisit, date)
        yield (member(record)[:-1],)


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = DATE) -> None:
    """Write pages (page_id, url, html) as archives below a new folder.

    Payload: the html in UTF-8, null as empty. Among records with equal payloads of at least
    ``least`` bytes those with the largest page_id are responses and the others revisit it; smaller
    ones and rows without page_id are all responses. Repeated rows are written each. An empty table
    gives an empty folder; further columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html"))
    long_enough = utf8_bytes(F.col("html")) >= least
    # Staged, so that the join below stands on two plain shuffles and a hot payload can be split.
    keepers = staged(
        rows.where(long_enough).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.min("page_id").alias("other"))
        .where(F.col("other") < F.col("keeper")).drop("other"), "keepers",
    )
    revisit = F.coalesce(long_enough & (F.col("page_id") < F.col("keeper")), F.lit(False))
    judged = rows.join(keepers, "digest", "left").select(
        "page_id", "url", "html", "keeper", revisit.alias("revisit")
    )
    (
        map_rows(judged, _members, MEMBERS, date, rows=256)
        .select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


class ArchiveReader:
    """Records of one archive in order, inflated step by step from a file-like object."""

    def __init__(self, source, path: str = ""):
        self.source, self.path = source, path
        self._raw = b""
        self._plain = bytearray()
        self._inflate = None
        self._ended = False

    def _more(self) -> bool:
        """Inflate another step of the current member; False at its end."""
        if self._inflate is None or self._inflate.eof:
            return False
        if not self._raw:
            self._raw = self.source.read(STEP)
            if not self._raw:
                raise EOFError(f"{self.path}: a gzip member is cut off")
        self._plain += self._inflate.decompress(self._raw, STEP)
        self._raw = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
        return True

    def _next_member(self) -> bool:
        if not self._raw:
            self._raw = self.source.read(STEP)
        if not self._raw:
            return False
        self._inflate = zlib.decompressobj(31)
        self._plain = bytearray()
        return True

    def _until(self, mark: bytes) -> bytes | None:
        """What stands before a mark; None if the member ends empty."""
        seen = 0
        while (at := self._plain.find(mark, seen)) < 0:
            seen = max(0, len(self._plain) - len(mark) + 1)
            if not self._more():
                if not self._plain:
                    return None
                raise ValueError(f"{self.path}: header without end")
        found = bytes(self._plain[:at])
        del self._plain[: at + len(mark)]
        return found

    def _exactly(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in steps."""
        while n:
            if not self._plain and not self._more():
                raise EOFError(f"{self.path}: a block is shorter than its content length")
            part = bytes(self._plain[:n])
            del self._plain[: len(part)]
            n -= len(part)
            if part:
                yield part

    def __iter__(self) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
        """(header, block in steps) of every record; a block must be used up before the next."""
        while self._next_member():
            head = self._until(b"\r\n\r\n")
            if head is None:
                continue
            version, *lines = head.split(b"\r\n")
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{self.path}: no WARC record")
            pairs = (line.decode().partition(":") for line in lines)
            header = {name.strip().lower(): value.strip() for name, _, value in pairs}
            block = self._exactly(int(header["content-length"]))
            yield header, block
            for _ in block:
                pass
            while self._more():
                pass
            if bytes(self._plain) != b"\r\n\r\n":
                raise ValueError(f"{self.path}: a record doesn't end with its block")


class _Block:
    """Digests and payload of one block as it is inflated."""

    def __init__(self, header: dict[str, str], keep: bool):
        self.header, self.keep = header, keep
        self.whole, self.payload = hashlib.sha1(), hashlib.sha1()
        self.http = b""
        self.open = not header.get("content-type", "").startswith("application/http")
        self.bytes = 0
        self.kept: list[bytes] = []

    def add(self, part: bytes) -> None:
        self.whole.update(part)
        if not self.open:
            self.http += part
            head, mark, part = self.http.partition(b"\r\n\r\n")
            if not mark:
                return
            self.http, self.open = head, True
        self.payload.update(part)
        self.bytes += len(part)
        if self.keep:
            self.kept.append(part)

    def result(self) -> tuple[int, str, bytes | None, bool]:
        """Bytes and digest of the full payload, the payload itself, whether all digests agree."""
        named = self.header.get("warc-payload-digest", "").removeprefix("sha1:")
        stated = self.header.get("warc-block-digest", "").removeprefix("sha1:")
        block = base64.b32encode(self.whole.digest()).decode()
        payload = base64.b32encode(self.payload.digest()).decode()
        intact = stated in ("", block)
        if self.header["warc-type"] == "revisit":
            length = next(
                (int(v) for n, _, v in (x.partition(b":") for x in self.http.split(b"\r\n"))
                 if n.strip().lower() == b"content-length"), 0,
            )
            return length, named, None, intact
        return self.bytes, payload, b"".join(self.kept) if self.keep else None, (
            intact and named in ("", payload)
        )


def _read(columns: dict, keep: bool) -> Iterator[tuple]:
    import io

    for path, content in zip(columns["path"], columns["content"], strict=True):
        for number, (header, parts) in enumerate(ArchiveReader(io.BytesIO(content), path)):
            block = _Block(header, keep)
            for part in parts:
                block.add(part)
            n, digest, payload, intact = block.result()
            row = (
                path, number, header["warc-type"], header.get("warc-record-id"),
                header.get("warc-refers-to"), header.get("warc-target-uri"),
                header.get("warc-date"), n, digest,
            )
            yield (*row, payload, intact) if keep else (*row, intact)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below a folder: type, ids, bytes and digest of the full payload, ``intact``.

    A record whose digests don't agree has ``intact`` false; a cut-off archive is an error. Files are
    dealt whole, one is in memory at a time; the writer bounds their records.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_rows(files, _read, RECORDS if payloads else NARROW, payloads, rows=256)


def page_of(name: Column) -> Column:
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder and read them back.

    Per page: page_id, payload_bytes, payload_digest (base32 SHA-1) of the full payload, record_type,
    refers_to (page_id of the response, for revisits). A record that isn't intact is an error.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    read = read_archives(spark, path, payloads=False)
    return read.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.when(F.col("intact"), F.col("record_type"))
        .otherwise(F.raise_error(F.lit("digest mismatch"))).alias("record_type"),
        page_of(F.col("refers_to")).alias("refers_to"),
    )
