"""WARC archives: write pages as records, and a salvage reader that survives damage.

Writing: pages with equal payloads are found by SHA-1 and length; the largest page id holds the
payload in a response record, the others become revisit records that name it. Each record
is a gzip member of its own, so a reader can start at any of them.

Reading: every member is decompressed and checked (gzip checksum), every record is checked
(version line, headers, block length, closing blank lines, block digest). Where a check fails,
the reader searches for the next gzip member that decompresses, or the next version line, goes on
from there, and reports the bytes between as a gap with the reason.

Archives are read by Spark's binary reader, a whole file per row, so files should stay of the
order of ``file_bytes``; what ``write`` makes does.

Defined results: null html is an empty payload, null urls leave the target out; several rows
of the largest page id and one payload are all responses; null page ids sort below all others
(a group of null ids only is all responses); pages may come in any order; an empty table
writes no file; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.llm import shared_files
from millwright.llm.arrow import map_rows
from millwright.session import materialize

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
VERSION_LINE = re.compile(rb"WARC/[01]\.[0-9]+\r?\n")
MEMBER = b"\x1f\x8b\x08"
URN = "urn:page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit has the HTTP headers only; Content-Length there is that of the full payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{URN}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "WARC-Refers-To": f"<{URN}{refers_to}>" if revisit else None,
        "WARC-Profile": PROFILE if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


BLANK_LINE = re.compile(rb"\r?\n\r?\n")


class Damaged(ValueError):
    pass


def _plain_record(data: memoryview, at: int) -> tuple[dict[str, str], memoryview, int]:
    """Headers, block and end of the record at ``at``; raises Damaged."""
    size = 65_536
    version = VERSION_LINE.match(bytes(data[at : at + size]))
    if not version:
        raise Damaged("no version line")
    while True:  # headers may be of any length
        front = bytes(data[at : at + size])
        stop = BLANK_LINE.search(front, version.end() - 1)
        if stop:
            break
        if at + size >= len(data):
            raise Damaged("headers do not end")
        size *= 4
    headers = {}
    for line in front[version.end() : stop.start()].splitlines():
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("no length")
    begin = at + stop.end()
    end = begin + int(headers["content-length"])
    block = data[begin:end]
    if len(block) < end - begin:
        raise Damaged("cut off")
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        raise Damaged("no closing blank lines")
    claimed = headers.get("warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:] != base32_sha1(bytes(block)):
        raise Damaged("block digest")
    return headers, block, end + 4


def _plain(data: memoryview, base: int | None) -> Iterator[tuple]:
    """('record', offset, length, headers, block) and ('gap', offset, length, reason) of uncompressed data.

    Offsets are those in the file; within a compressed member (``base`` given) all are the member's."""
    at, raw = 0, None
    while at < len(data):
        try:
            headers, block, end = _plain_record(data, at)
            yield "record", at if base is None else base, end - at, headers, block
            at = end
        except Damaged as why:
            raw = bytes(data) if raw is None else raw
            found = next((m.start() for m in VERSION_LINE.finditer(raw, at + 1)), len(raw))
            yield "gap", at if base is None else base, found - at, str(why)
            at = found


def _member_end(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``; raises Damaged."""
    unpacker, out, begin = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof and at < len(data):
            piece = data[at : at + 65_536]
            out.append(unpacker.decompress(piece))
            at += len(piece)
    except zlib.error as error:
        raise Damaged(f"member: {str(error)[:60]}") from None
    if not unpacker.eof:
        raise Damaged("member cut off")
    end = at - len(unpacker.unused_data)
    if end <= begin:
        raise Damaged("empty member")
    return b"".join(out), end


def salvage(content: bytes) -> Iterator[tuple]:
    """Records and gaps of one archive, compressed by member, plain, or mixed."""
    data, at, gap, reason = memoryview(content), 0, None, ""
    while at < len(data):
        start = at
        if bytes(data[at : at + 3]) == MEMBER:
            try:
                inner, at = _member_end(data, at)
            except Damaged as why:
                inner = None
                gap, reason = (start, str(why)) if gap is None else (gap, reason)
            if inner is not None:
                if gap is not None:
                    yield "gap", gap, start - gap, reason
                    gap = None
                yield from _plain(memoryview(inner), start)
                continue
        else:
            try:
                headers, block, end = _plain_record(data, at)
                if gap is not None:
                    yield "gap", gap, at - gap, reason
                    gap = None
                yield "record", at, end - at, headers, block
                at = end
                continue
            except Damaged as why:
                gap, reason = (start, str(why)) if gap is None else (gap, reason)
        nexts = [k for k in (content.find(MEMBER, start + 1), _next_version(content, start + 1)) if k >= 0]
        at = min(nexts, default=len(data))
    if gap is not None:
        yield "gap", gap, len(data) - gap, reason


def _next_version(content: bytes, start: int) -> int:
    return next((m.start() for m in VERSION_LINE.finditer(content, start)), -1)


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): which pages repeat the payload of a larger page id.

    Counted by digest with map-side combine. The rows of all pages are joined with the digests held more than once; where
    those are too many to broadcast, that shuffles the payloads once.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("bytes"))
    shared = (keyed.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes")
              .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("largest"))
              .where("copies > 1").select("sha1", "bytes", "largest"))
    holder = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return keyed.join(shared, ["sha1", "bytes"], "left").select("page_id", "url", "payload", holder.alias("refers_to"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
          file_bytes: int = 4 << 20) -> DataFrame:
    """Write all pages; returns the list of files (name, n_records), stored."""
    shared_files.make_folder(folder)

    def run(batches):
        import pyarrow as pa

        task, pieces, files, size = TaskContext.get().partitionId(), [], [], 0

        def close():
            nonlocal size
            name = shared_files.put(folder, f"{task:06d}-{len(files):06d}.warc.gz", pieces)
            files.append({"name": name, "n_records": len(pieces)})
            pieces.clear()
            size = 0

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                for row in batch.slice(start, 200).to_pylist():
                    pieces.append(member(record(row["page_id"], row["url"], row["payload"], row["refers_to"], date)))
                    size += len(pieces[-1])
                    if size >= file_bytes:
                        close()
        if pieces:
            close()
        yield pa.RecordBatch.from_pylist(files, pa.schema({"name": pa.string(), "n_records": pa.int64()}))

    return materialize(with_roles(pages, least_bytes).mapInArrow(run, "name string, n_records long"), "warc-files")


READ_SCHEMA = ("file string, kind string, offset long, length long, reason string, record_id string, record_type string, "
               "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary")


def read(spark: SparkSession, folder: str, glob: str = "*.warc.gz", payloads: bool = True) -> DataFrame:
    """One row per record (kind 'record') and per quarantined byte range (kind 'gap', with the reason).

    Digest and length of a response are computed from the payload that was read; those of a
    revisit are its headers'. ``payloads=False`` leaves the payload out.
    """
    opened = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "content")

    def rows(batch):
        for row in batch:
            for kind, offset, length, *rest in salvage(row["content"]):
                out = {"file": row["path"], "kind": kind, "offset": offset, "length": length}
                if kind == "gap":
                    yield out | {"reason": rest[0]}
                    continue
                headers, block = rest
                yield out | describe(headers, bytes(block), payloads)

    return map_rows(opened, rows, READ_SCHEMA, at_once=1)


def describe(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = headers.get("warc-type")
    head, _, payload = block.partition(b"\r\n\r\n")
    if not headers.get("content-type", "").startswith("application/http"):
        head, payload = b"", block
    out = {"record_id": headers.get("warc-record-id"), "record_type": kind, "target_uri": headers.get("warc-target-uri"),
           "refers_to": headers.get("warc-refers-to")}
    if kind == "revisit":
        full = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        digest = headers.get("warc-payload-digest", "")
        return out | {"payload_bytes": int(full[1]) if full else None, "payload_digest": digest.removeprefix("sha1:") or None}
    return out | {"payload_bytes": len(payload), "payload_digest": base32_sha1(payload), "payload": payload if payloads else None}


def without_gaps(records: DataFrame) -> DataFrame:
    """The same rows; a gap raises. For archives that were written whole."""
    lost = F.raise_error(F.concat_ws(" ", F.lit("gap in"), "file", "offset", "reason"))
    return records.where(F.when(F.col("kind") == "record", True).otherwise(lost.cast("boolean")))


def page_records(records: DataFrame) -> DataFrame:
    """Records as pages: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    number = lambda c: F.expr(f"try_cast(nullif(regexp_extract({c}, '<{URN}(-?[0-9]*)>', 1), '') as bigint)")
    return records.where("kind = 'record'").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
