"""WARC archives: a writer with revisits, and a reader that salvages what it can.

Writer: one record per page, each a gzip member of its own. Pages of equal payload share a digest; the
one with the least page_id is a `response`, the others are `revisit` records that refer to it and have no payload.
Archives go through Spark's own writer to any store it can reach: a row is about BLOCK bytes of pages, as members one after
the other, and the separator after each row is a gzip member of length 0.

Reader: an archive is one row of Spark's binary source (2 GiB at most; the writer's hold about
ARCHIVE bytes) and may mix gzip members and plain records. Each record is checked: member CRC, version line,
headers, Content-Length, the two line ends after the block, payload digest. After a failed check the
reader searches for the next gzip member that opens, or the next version line, that begins a record
which passes; it goes on there, and the bytes in between are returned as a gap, with the reason. A member is
searched in the same way for version lines in what it decompresses to, as far as it does; a gap in a member
has the member's offset and length, and its place in the decompressed bytes in the reason. What follows
a member's damage, up to the next member or record of the archive that passes, counts to its length.

Nulls and so on: a null payload is empty, and empty payloads are equal; null page_ids sort after all
others when the least is sought, and a group without any page_id, and each of several rows that share the least, is
a response; a null url is written as urn:page:<page_id>; extra columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm._stage import Stage

#: Bytes of payload in an archive, about.
ARCHIVE = 16 << 20
#: Bytes of payload in a row of the writer, about.
BLOCK = 1 << 20
_EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + "\x00" * 8
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|WARC/1\.[01]\r\n", re.S)


def base32_sha1(text) -> F.Column:
    """Upper-case base32 of SHA-1, from five hexadecimal digits to four letters at a time."""
    hexed = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, size: int, sha: str, refers_to) -> bytes:
    """A response record, or with refers_to a revisit."""
    name = "" if page_id is None else page_id
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{name}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{sha}",
        *(
            [] if refers_to is None else [
                f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            ]
        ),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(batches):
    for batch in batches:
        rows, out, n = batch.to_pydict(), [[]], 0
        for page_id, url, payload, size, sha, first in zip(*(rows[k] for k in ("page_id", "url", "html", "size", "sha", "first"))):
            if n >= BLOCK:
                out, n = [*out, []], 0
            n += size
            z = zlib.compressobj(3, zlib.DEFLATED, 31)
            out[-1] += [
                z.compress(record(page_id, url, (payload or "").encode(), size, sha, None if first is None or first == page_id else first)),
                z.flush()
            ]
        yield pa.RecordBatch.from_pydict({"value": pa.array([b"".join(x) for x in out if x], pa.binary())})


def write(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE) -> None:
    """Archives of pages (page_id, url, html) in a new folder."""
    text = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", "url", "html").withColumns({"sha": base32_sha1(text), "size": F.octet_length(text).cast("long")})
    same = p.groupBy("sha", "size").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1").drop("n")
    marked = p.join(same, ["sha", "size"], "left")
    members = marked.select("page_id", "url", "html", "size", "sha", "first").mapInArrow(_members, "value binary")
    out = members.select(
        F.col("value").cast("string").alias("value")
    ).write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER)
    out.option("maxRecordsPerFile", max(1, archive_bytes // BLOCK)).option("compression", "none").text(path)


_FIELD = re.compile(rb"[!-9;-~]+:[^\x00-\x08\x0a-\x1f]*\Z")


class Bad(Exception):
    """A check that failed."""


def parse(raw: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and end of the plain record at a place."""
    if not _VERSION.match(raw, at):
        raise Bad("no version line")
    end = raw.find(b"\r\n\r\n", at)
    if end < 0:
        raise Bad("headers without end")
    head = {}
    for line in raw[at:end].split(b"\r\n")[1:]:
        if not _FIELD.match(line):
            raise Bad("a line that is no header")
        k, _, v = line.partition(b":")
        head[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not head.get("warc-type") or not head.get("warc-record-id"):
        raise Bad("no WARC-Type or WARC-Record-ID")
    if not head.get("content-length", "").isdigit():
        raise Bad("no Content-Length")
    start = end + 4
    stop = start + int(head["content-length"])
    if raw[stop : stop + 4] != b"\r\n\r\n":
        raise Bad("no record end where Content-Length puts it")
    block = raw[start:stop]
    said = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and said.startswith("sha1:") and said[5:] != digest(payload_of(block)):
        raise Bad("payload digest differs")
    return head, block, stop + 4


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers."""
    if not block.startswith(b"HTTP/"):
        return block
    i = block.find(b"\r\n\r\n")
    return block[i + 4 :] if i >= 0 else b""


#: Compressed bytes that are decompressed at once: few at first, as most members are short, and what is left over is copied.
_FIRST, _STEP = 1 << 12, 1 << 16


def _inflate(raw: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at a place decompresses to before its end or first error; where that is; the error."""
    z, out, i = zlib.decompressobj(31), [], at
    while not z.eof and i < len(raw):
        before, step = z.copy(), raw[i : i + (_FIRST if i == at else _STEP)]
        try:
            out.append(z.decompress(step))
        except zlib.error as e:
            # the step again byte by byte: what comes before the error counts
            for k in range(len(step)):
                try:
                    out.append(before.decompress(step[k : k + 1]))
                except zlib.error:
                    return b"".join(out), i + k, f"gzip: {e}"
        i += len(step)
    return b"".join(out), i - len(z.unused_data), None if z.eof else "gzip: member without end"


def _plain(raw: bytes) -> Iterator[tuple[int, int, dict | None, bytes, str | None]]:
    """salvage() of bytes that hold plain records only."""
    at = 0
    while at < len(raw):
        try:
            head, block, end = parse(raw, at)
            yield at, end - at, head, block, None
            at = end
        except Bad as e:
            go = at + 1
            while m := _VERSION.search(raw, go):
                go = m.start()
                try:
                    parse(raw, go)
                    break
                except Bad:
                    go += 1
            else:
                go = len(raw)
            yield at, go - at, None, b"", str(e)
            at = go


def _member(raw: bytes, at: int) -> tuple[list[tuple[dict | None, bytes, str | None]], int | None]:
    """Records and gaps of the gzip member at a place, in order; its end, None if it is damaged."""
    plain, end, error = _inflate(raw, at)
    found = [(head, block, reason and f"{reason}, at {a} to {a + n} of the member") for a, n, head, block, reason in _plain(plain)]
    if not any(head for head, _, _ in found) and (error or found):
        raise Bad(error or found[0][2].rsplit(", at ", 1)[0])
    if error and not found[-1][2]:
        found.append((None, b"", f"{error}, at {len(plain)} of the member"))
    return found, None if error else end


def salvage(raw: bytes) -> Iterator[tuple[int, int, dict | None, bytes, str | None]]:
    """(offset, length, headers, block, None) of each record and (offset, length, None, b"", reason) of each gap, in order."""
    at, ready = 0, None
    while at < len(raw):
        failed = None
        try:
            found, end = ready or _next(raw, at)
        except Bad as e:
            found, end, failed = [], None, str(e)
        ready = None
        if end is None:
            end, *ready = _after(raw, at + 1)
        if failed:
            yield at, end - at, None, b"", failed
        for head, block, reason in found:
            yield at, end - at, head, block, reason
        at = end


def _after(raw: bytes, go: int) -> tuple[int, list, int | None]:
    """Where the next member or record that passes begins, what it holds and where it ends."""
    while m := _MEMBER.search(raw, go):
        try:
            found, end = _next(raw, m.start())
            if found:
                return m.start(), found, end
        except Bad:
            pass
        go = m.start() + 1
    return len(raw), [], len(raw)


def _next(raw: bytes, at: int) -> tuple[list[tuple[dict | None, bytes, str | None]], int | None]:
    if raw[at : at + 2] == b"\x1f\x8b":
        return _member(raw, at)
    head, block, end = parse(raw, at)
    return [(head, block, None)], end


READ = "file string, offset long, length long, reason string, type string, record_id string, uri string, refers_to string, payload_bytes long, payload_digest string"


def _records(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                for offset, length, head, block, reason in salvage(content.as_py()):
                    if head is None:
                        rows.append((path.as_py(), offset, length, reason, *[None] * (7 if with_payload else 6)))
                        continue
                    body = payload_of(block)
                    if head.get("warc-type") == "revisit":
                        m = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", block)
                        size, sha = int(m[1]) if m else None, head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    else:
                        size, sha = len(body), digest(body)
                    row = (
                        path.as_py(), offset, length, None, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"),
                        head.get("warc-refers-to"), size, sha
                    )
                    rows.append(row + (body,) if with_payload else row)
                names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * with_payload
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string()] + [pa.binary()] * with_payload
                for i in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 2000]), kinds)], names)

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps (those have a `reason`) of all archives in a folder."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_records(with_payload), READ + ", payload binary" * with_payload)


def op1_warc_salvage(spark, sf_dir: str) -> DataFrame:
    """The records; the gaps, with file, offset, length and reason, stay beside them in the table `read` of the stage's folder."""
    stage = Stage(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{stage.at}/archives")
    found = stage.save(read(spark, f"{stage.at}/archives", with_payload=False), "read")
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    records = found.where("reason IS NULL")
    return records.select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        number(F.col("refers_to")).alias("refers_to")
    )


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
"""
