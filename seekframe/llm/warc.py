"""WARC archives: a writer with revisit records, and a reader that survives damage.

Records are built as columns and written by Spark's text sink, whose line separator is the pair of
line ends that closes a record. So files appear on any file system Spark can write, and a lost
executor leaves no half-written archive.

The reader checks every record: version line, header, length, closing line ends and payload digest.
After a failed check it looks for the next version line, or the next gzip member, that begins a
valid record, goes on from there, and lists the bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.operators.skew import join_lookup
from seekframe.session import materialise

LEAST_BYTES = 1000  # smaller payloads are stored again rather than referred to
FILE_RECORDS = 4000  # a reader task holds one file
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def write_archive(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url",
                  html: str = "html", least_bytes: int = LEAST_BYTES,
                  file_records: int = FILE_RECORDS, compression: str = "none") -> None:
    """One record per row; the payload is ``html`` in UTF-8, null counts as empty.

    Of records with equal payloads of at least ``least_bytes``, the one with the largest id is the
    response and the others are revisits without payload. Rows that repeat the largest id are all
    responses; a null id is smaller than any other. Blanks and control characters in a url are
    written as %20; a null url leaves its line out. Extra columns are not written. Plain files lose
    least to damage; ``compression='gzip'`` makes each file one member.
    """
    body = pages.select(
        F.col(id_column).alias("id"), F.col(url).alias("uri"),
        F.coalesce(F.col(html), F.lit("")).alias("body")) \
        .withColumn("bytes", F.octet_length("body").cast("long")) \
        .withColumn("digest", F.sha1(F.encode("body", "UTF-8")))
    # One row per payload that occurs more than once, by its digest and length.
    owners = body.filter(F.col("bytes") >= least_bytes) \
        .groupBy(F.concat_ws(":", "digest", "bytes").alias("key")) \
        .agg(F.max("id").alias("owner"), F.count("*").alias("times")) \
        .filter(F.col("times") > 1).select("key", "owner")
    body = body.withColumn("key", F.concat_ws(":", "digest", "bytes"))
    placed = join_lookup(body, materialise(owners, "warc-owners"), "key", "left", salts=1)
    again = F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("bytes"), F.lit(_END))
    block = F.concat(http, F.when(again, "").otherwise(F.col("body")))
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "),
                      F.regexp_replace("uri", r"[\x00-\x20\x7F]", "%20")),
             F.concat(F.lit("WARC-Date: "),
                      F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
             F.concat(F.lit("X-Payload-Bytes: "), F.col("bytes")),
             F.when(again, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("owner"), F.lit(">"))),
             F.when(again, F.lit(f"WARC-Profile: {_PROFILE}")),
             F.lit("Content-Type: application/http;msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length("_block"))]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), F.col("_block"))
    placed.withColumn("_block", block).select(record.alias("value")).write \
        .option("lineSep", _END).option("compression", compression) \
        .option("maxRecordsPerFile", file_records).text(path)


@dataclass
class Found:
    """A valid record, or a gap if ``reason`` is set. ``start`` and ``size`` are bytes of the file;
    for a record in a member that holds several, those of the member."""
    start: int
    size: int
    reason: str = ""
    header: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _record(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """(end, header, payload) of the record at ``at``, or what is wrong with it."""
    if not _VERSION.match(data, at):
        return "no version line"
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return "header without end"
    header = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return "broken header line"
        header[name.strip().decode("utf-8", "replace").lower()] = \
            value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not re.fullmatch("[0-9]{1,15}", length):
        return "no content length"
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return "truncated" if end + 4 > len(data) else "length does not fit"
    block = data[begin:end]
    is_http = header.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if is_http else block
    digest = header.get("warc-payload-digest", "")
    if header.get("warc-type") != "revisit" and digest.startswith("sha1:") \
            and hashlib.sha1(payload).hexdigest() != digest[5:]:
        return "digest does not fit"
    return end + 4, header, payload


def _next_after(data: bytes, at: int, starts) -> int:
    """Where the record at ``at`` ends by its own header, if a valid start or the end follows."""
    stop = data.find(b"\r\n\r\n", at)
    length = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,15})\r\n", data[at:stop + 2]) \
        if stop >= 0 and _VERSION.match(data, at) else None
    end = stop + 8 + int(length[1]) if length else -1
    return end if end == len(data) or 0 <= end < len(data) and starts(data, end) else -1


def _starts_record(data: bytes, at: int) -> bool:
    return not isinstance(_record(data, at), str)


def _starts_any(data: bytes, at: int) -> bool:
    """Whether a valid record stands at ``at``, or a member whose content begins with one."""
    if not data.startswith(_MEMBER, at):
        return _starts_record(data, at)
    try:  # a few bytes tell most other gzip data, such as a packed payload
        head = zlib.decompressobj(31).decompress(memoryview(data)[at:at + 4096], 16)
    except zlib.error:
        return False
    return bool(_VERSION.match(head)) and _starts_record(_member(data, at)[1], 0)


def _damaged(data: bytes, at: int, starts) -> int:
    """Where the next record or member begins, whichever it is, or the end of the data."""
    # An intact frame around damaged content is skipped whole: its content may hold text that looks
    # like a record.
    end = _next_after(data, at, starts)
    if end >= 0:
        return end
    return next((m.start() for m in _START.finditer(data, at + 1) if starts(data, m.start())),
                len(data))


def _plain(data: bytes) -> Iterator[Found]:
    """Records and gaps of a member's content."""
    at = 0
    while at < len(data):
        got = _record(data, at)
        if isinstance(got, str):
            end = _damaged(data, at, _starts_record)
            yield Found(at, end - at, got)
        else:
            end = got[0]
            yield Found(at, end - at, "", *got[1:])
        at = end


def _member(data: bytes, at: int) -> tuple[int, bytes, str]:
    """(end, content, error) of the gzip member at ``at``."""
    inflate, parts, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        for begin in range(at, len(data), 1 << 16):
            parts.append(inflate.decompress(view[begin:begin + (1 << 16)]))
            if inflate.eof:
                end = min(begin + (1 << 16), len(data)) - len(inflate.unused_data)
                return end, b"".join(parts), ""
        return len(data), b"".join(parts), "truncated member"
    except zlib.error:
        return -1, b"".join(parts), "broken member"


def salvage(data: bytes) -> Iterator[Found]:
    """All valid records of an archive and the gaps between them, in order.

    Each place is read as what stands there, a plain record or a gzip member, so one file may hold
    both, and gzip's first bytes inside a payload do not change how the rest is read. Every byte
    belongs to exactly one record, member or gap. An empty file has neither.
    """
    at = 0
    while at < len(data):
        if data.startswith(_MEMBER, at):
            end, content, error = _member(data, at)
            for f in _plain(content):
                if not error:
                    yield Found(at, end - at, f.reason, f.header, f.payload)
                elif not f.reason:  # whole records before the damage
                    yield Found(at, 0, "", f.header, f.payload)
        else:
            got = _record(data, at)
            error = got if isinstance(got, str) else ""
            if not error:
                end = got[0]
                yield Found(at, end - at, "", *got[1:])
        if error:
            end = _damaged(data, at, _starts_any)
            yield Found(at, end - at, error)
        at = end


SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("size", T.LongType()), T.StructField("reason", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records and gaps of all archive files below ``path``.

    Gaps have a ``reason`` and no record columns. Bytes and digest are those of the full payload:
    taken from the payload itself, or for a revisit from its header. With ``payload=False`` that
    column is null.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                out = []
                for f in salvage(bytes(content)):
                    get = f.header.get
                    if f.reason:
                        out.append((file, f.start, f.size, f.reason, *[None] * 7))
                        continue
                    kind = get("warc-type")
                    whole = kind != "revisit"
                    size = len(f.payload) if whole else int(get("x-payload-bytes", "0"))
                    digest = hashlib.sha1(f.payload).hexdigest() if whole else \
                        get("warc-payload-digest", "").removeprefix("sha1:")
                    out.append((file, f.start, f.size, None, get("warc-record-id"), kind,
                                get("warc-target-uri"), get("warc-refers-to"), size, digest,
                                f.payload if payload else None))
                    if len(out) >= 1000:
                        yield _frame(out)
                        out = []
                if out:
                    yield _frame(out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(rows, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series(list(c), dtype="Int64" if f.dataType == T.LongType() else object)
                         for f, c in zip(SCHEMA.fields, zip(*rows))})


def records(archive: DataFrame) -> DataFrame:
    """The valid records of ``read_archive``."""
    return archive.filter(F.col("reason").isNull()).drop("reason")


def whole_records(archive: DataFrame) -> DataFrame:
    """The records of ``read_archive``; reading fails at a gap."""
    said = F.concat_ws(" ", F.lit("gap in"), "file", F.lit("at"), "start", F.lit(":"), "reason")
    return archive.filter(F.when(F.col("reason").isNull(), F.lit(True))
                          .otherwise(F.raise_error(said).cast("boolean"))).drop("reason")


def gaps(archive: DataFrame) -> DataFrame:
    """The quarantined byte ranges of ``read_archive``."""
    return archive.filter(F.col("reason").isNotNull()).select("file", "start", "size", "reason")


def page_of(urn: str) -> Column:
    """The page id inside a record id; null where it has none."""
    number = F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number).cast("long")
