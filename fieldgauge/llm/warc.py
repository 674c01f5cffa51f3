"""WARC archives of web pages: written as segmented records, read back and reassembled.

A page becomes a response record with its payload in chunked transfer framing, or a revisit
record if an equal payload has a smaller page id.  Blocks longer than a segment go on in
continuation records.  Reading groups continuations by the identifier of their origin, orders
them by segment number, verifies the total length and decodes the framing.

Archives are gzip files, written and read by Spark's text source with the version line as the
separator, so they can lie in any file system that Spark reaches.  A gzip file is never split,
so its records come in their order to one task, one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections import deque
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable, per_batch
from fieldgauge.session import materialise, staging_path

#: bytes of a block in one record, and of a chunk of the payload
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
#: a record that claims a longer block is broken
MOST_BLOCK = 1 << 28
#: no capture time is given, so records carry this one
DATE = "1970-01-01T00:00:00Z"

_VERSION = b"WARC/1."
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: bytes of records that a task hands on at once
_HANDED = 1 << 24


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        chunk = payload[at : at + size]
        parts += [b"%x\r\n" % len(chunk), chunk, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of chunked framing; None where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return None
        length, at = int(size, 16), end + 2
        if length == 0:
            # trailer fields, if any, end with an empty line
            return b"".join(parts) if body[at:].endswith(b"\r\n") else None
        if body[at + length : at + length + 2] != b"\r\n":
            return None
        parts.append(body[at : at + length])
        at += length + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its last line break, which the text writer adds."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"%s1\r\n%sContent-Length: %d%s%s\r\n" % (_VERSION, head.encode(), len(block), _END, block)


def page_records(
    page: str | None, url: str | None, payload: bytes, first: str | None, first_url: str | None, name: str,
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, revisits: bool = False,
) -> Iterator[bytes]:
    """The records of one page; ``first`` is the page that a revisit refers to."""
    ident = lambda n: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{n}')}>"
    # header values hold no control characters and no spaces
    address = lambda x: None if x is None else quote(x, safe="!#$%&'()*+,/:;=?@[]~")
    label = lambda x: None if x is None else quote(x, safe="")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", address(url))]
    about = [("X-Page-ID", label(page)), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
             ("Content-Type", "application/http; msgtype=response")]
    if revisits:
        block = f"{_HTTP}Content-Length: {len(payload)}\r\n\r\n".encode()
        to = [("WARC-Profile", _PROFILE), ("WARC-Refers-To-Target-URI", address(first_url)), ("WARC-Refers-To-Date", DATE),
              ("X-Refers-To-Page-ID", label(first))]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", ident(1)), *common, *about, *to], block)
        return
    block = f"{_HTTP}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload, chunk_bytes)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", ident(1)), *common, *about]
    if len(block) <= segment_bytes:
        yield _record(head, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        if number == 1:
            fields = [*head, ("WARC-Segment-Number", 1)]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", ident(number)), *common,
                      ("WARC-Segment-Origin-ID", ident(1)), ("WARC-Segment-Number", number),
                      ("WARC-Segment-Total-Length", len(block) if number == len(cuts) else None)]
        yield _record(fields, block[at : at + segment_bytes])


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("binary"), F.lit(b""))


def captures(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """page, url, payload, first, first_url, revisits: the pages as they are to be written.

    Of equal payloads of ``at_least`` bytes the smallest page_id is kept as the response, a null
    one only if all are null; rows that tie for it are all responses.  Payloads meet by their
    SHA-256; only digests that occur twice reach the join.
    """
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), F.col("page_id").alias("id"), F.col("url").alias("at"))
    slim = pages.select("page_id", "url", F.sha2(_payload(), 256).alias("key"), F.octet_length(_payload()).alias("n"))
    # written first, so that the join deals both sides anew and a hot payload can be split
    firsts = materialise(
        slim.where(F.col("n") >= at_least).groupBy("key")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
        .select(F.col("key").alias("same"), "first"),
        "payloads",
    )
    whole = pages.select("page_id", "url", _payload().alias("payload"), F.sha2(_payload(), 256).alias("key"))
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.id"))
    return whole.join(firsts, F.col("key") == F.col("same"), "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "payload", F.col("first.id").cast("string").alias("first"),
        F.col("first.at").alias("first_url"), later.alias("revisits"),
    )


def write_archives(
    pages: DataFrame, path: str, at_least: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES
) -> None:
    """Writes a record per row of ``pages`` (page_id, url, html), and its continuations, below ``path``.

    Payloads are the html in UTF-8, null as empty.  A page's records are written by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        out, held = [], 0
        for batch in batches:
            for page, url, payload, first, first_url, revisits in zip(*(c.to_pylist() for c in batch.columns)):
                n += 1
                for record in page_records(page, url, payload, first, first_url, f"{path}/{task}/{n}", segment_bytes,
                                           chunk_bytes, revisits):
                    out.append(record)
                    held += len(record)
                if held > _HANDED:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    importable(pages.sparkSession)
    records = captures(pages, at_least).mapInArrow(run, "record binary")
    # the text writer puts down the bytes of a string as they are
    records.select(F.col("record").cast("string")).write.text(path, compression="gzip", lineSep="\r\n")


_FIELDS = ["warc-type", "warc-record-id", "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length",
           "warc-target-uri", "x-page-id", "x-refers-to-page-id", "warc-payload-digest"]
_NAMES = ["type", "record_id", "origin_id", "segment", "total", "target_uri", "page", "refers", "digest"]
_RECORD = ", ".join(f"{n} string" for n in _NAMES) + ", block binary, whole boolean"


def _head(text: bytes) -> dict[str, str]:
    """Fields of a record or response head; names in lower case."""
    fields = {}
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


class Records:
    """Turns what stands between version lines into records, by their content lengths.

    A version line may also occur inside a block: parts are joined until the content length is
    reached.  A part that does not fit is given out as broken, and the next is tried as a start.
    """

    def __init__(self) -> None:
        self.parts: deque[bytes] = deque()

    def add(self, part: bytes) -> Iterator[tuple]:
        self.parts.append(part)
        yield from self._drain(False)

    def end(self) -> Iterator[tuple]:
        yield from self._drain(True)

    def _drain(self, last: bool) -> Iterator[tuple]:
        while self.parts:
            start = self.parts[0]
            if start[:3] not in (b"0\r\n", b"1\r\n"):
                self.parts.popleft()  # no record starts here
                continue
            size = sum(map(len, self.parts)) + len(_VERSION) * (len(self.parts) - 1)
            need = self._need(start if start.find(_END) >= 0 else _VERSION.join(self.parts))
            if need is not None and size < need and not last:
                return
            if need is None and not last and size < 1 << 16:
                return  # the head is not complete
            if size == need:
                text = _VERSION.join(self.parts)
                self.parts.clear()
                yield self._row(text, True)
            else:
                self.parts.popleft()
                yield self._row(start, False)

    @staticmethod
    def _need(text: bytes) -> int | None:
        """Bytes of the whole record, -1 if that cannot be right, None before the end of the head."""
        end = text.find(_END)
        if end < 0:
            return None
        length = _head(text[:end]).get("content-length", "")
        if not length.isascii() or not length.isdigit() or int(length) > MOST_BLOCK:
            return -1
        return end + len(_END) + int(length) + len(_END)

    @staticmethod
    def _row(text: bytes, whole: bool) -> tuple:
        end = text.find(_END)
        fields = _head(text[: max(end, 0)])
        block = text[end + len(_END) : -len(_END)] if whole else b""
        return (*(fields.get(f) for f in _FIELDS), block, whole and text.endswith(_END))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the gzip archives below ``path``: header fields, block, whole.

    ``whole`` is false for records whose length is not the one stated; their block is empty.
    """
    importable(spark)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        *fields, block, whole = zip(*found)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(f, pa.string()) for f in fields), pa.array(block, pa.binary()), pa.array(whole, pa.bool_())],
            [*_NAMES, "block", "whole"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, records, out, held = None, Records(), [], 0
        for batch in batches:
            for path, part in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                found = []
                if path != file:
                    found += records.end()
                    file, records = path, Records()
                found += records.add(part)
                held += sum(len(x[-2]) for x in found)
                out += found
                if held > _HANDED:
                    yield rows(out)
                    out, held = [], 0
        out += records.end()
        if out:
            yield rows(out)

    parts = spark.read.text(path, lineSep=_VERSION.decode())
    return parts.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(
        run, _RECORD
    )


def reassemble(records: DataFrame) -> DataFrame:
    """One row per record that is not a continuation, its block whole again.

    Adds sound: every segment from 1 on is there once and the total length is the stated one.
    Segments whose first is missing give one row with no type and an empty block.
    """
    kept = ["type", "target_uri", "page", "refers", "digest"]
    number = F.expr("try_cast(segment AS int)")
    alone = records.where(F.col("segment").isNull()).select(*kept, "block", F.col("whole").alias("sound"))
    head = F.struct(*kept)
    grouped = (
        records.where(F.col("segment").isNotNull())
        .groupBy(F.coalesce("origin_id", "record_id").alias("origin"))
        .agg(
            F.sort_array(F.collect_list(F.struct(number.alias("at"), "block"))).alias("parts"),
            F.max(F.when(F.col("origin_id").isNull(), head)).alias("head"),
            F.max(F.expr("try_cast(total AS bigint)")).alias("total"), F.min("whole").alias("whole"),
        )
    )
    # strings are joined byte by byte, whatever their bytes are
    joined = grouped.withColumn(
        "block", F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    )
    in_order = F.transform("parts", lambda p: p["at"]) == F.sequence(F.lit(1), F.size("parts"))
    sound = F.col("whole") & F.col("head").isNotNull() & in_order & (F.octet_length("block") == F.col("total"))
    whole = joined.select(
        *[F.col(f"head.{c}").alias(c) for c in kept], F.when(F.col("head").isNotNull(), F.col("block")).otherwise(F.lit(b"")).alias("block"),
        F.coalesce(sound, F.lit(False)).alias("sound"),
    )
    return alone.unionByName(whole)


def _payload_of(kind: str | None, block: bytes, digest: str | None) -> tuple[bytes | None, int | None, str | None, bool]:
    """Payload, its bytes and digest, and whether they are sound."""
    head, end, body = block.partition(_END)
    if not end:
        return None, None, None, False
    fields = _head(head)
    length = fields.get("content-length", "")
    stated = (digest or "").removeprefix("sha1:") or None
    if kind == "revisit":  # the payload is that of the page referred to
        return None, int(length) if length.isdigit() else None, stated, length.isdigit() and stated is not None
    payload = dechunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body
    if payload is None:
        return None, None, stated, False
    found = payload_digest(payload)
    return payload, len(payload), found, stated in (None, found)


def decode(whole: DataFrame) -> DataFrame:
    """page, target_uri, type, refers, payload, payload_bytes, payload_digest, sound."""

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, blocks, digests = (batch.column(c).to_pylist() for c in ("type", "block", "digest"))
        payload, size, digest, good = zip(*map(_payload_of, kinds, blocks, digests))
        sound = [a and b for a, b in zip(good, batch.column("sound").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page", "target_uri", "type", "refers")), pa.array(payload, pa.binary()),
             pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array(sound, pa.bool_())],
            ["page", "target_uri", "type", "refers", "payload", "payload_bytes", "payload_digest", "sound"],
        )

    slim = whole.select("page", "target_uri", "type", "refers", "block", "digest", "sound")
    return per_batch(slim, build, "page string, target_uri string, type string, refers string, payload binary, "
                                  "payload_bytes bigint, payload_digest string, sound boolean")


def read_pages(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The pages of the archives below ``path``, one row per response or revisit record.

    page_id, target_uri (percent-encoded), record_type, refers_to (the response's page_id, null
    for responses), payload (null for revisits), payload_bytes and payload_digest (of the full
    payload), sound (all lengths and digests are right).
    """
    found = decode(reassemble(read_records(spark, path)))
    ident = lambda c: F.try_url_decode(F.col(c)).cast(id_type)
    return found.select(
        ident("page").alias("page_id"), "target_uri", F.col("type").alias("record_type"), ident("refers").alias("refers_to"),
        "payload", "payload_bytes", "payload_digest", "sound",
    )


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes ``pages`` to archives and reads them back; see ``write_archives`` and ``read_pages``.

    Every row of ``pages`` is one page of the result.  An empty table gives no records.  Columns
    other than page_id, url and html are not used.
    """
    spark = pages.sparkSession
    path = path or staging_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_pages(spark, path, dict(pages.dtypes)["page_id"])
