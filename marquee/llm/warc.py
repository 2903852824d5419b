"""WARC files: a writer, and a reader that splits files by byte range.

Each record is a gzip member of its own. Of pages with equal payloads (of at
least ``LEAST_BYTES``) the one with the smallest page_id is a response record,
the others are revisit records that name it and carry its digest and length.

A reading task gets a byte range. It looks for gzip's magic bytes, takes a
place for a member's start if decoding there gives a WARC version line and a
whole header, and owns every record that starts inside its range; the last
one may end outside. From a valid member on, the next start is known.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

from .frames import partitions, small_batches, written
from .tokenfile import store
from .words import slices

LEAST_BYTES = 100
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
OPENING = re.compile(rb"WARC/\d+\.\d+\r?\n")  # of any version's record
DATE = "2000-01-01T00:00:00Z"  # fixed, so that equal pages give equal records
LEVEL = 4


def _member(head: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    raw = VERSION + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    coder = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return coder.compress(raw) + coder.flush()


def _name(page: int) -> str:
    return f"<urn:page:{page}>"


def _uri(url: str | None) -> str | None:
    """The url on one line; blanks at its ends and control characters are escaped."""
    if url is None:
        return None
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page)),
            ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        return _member(head, http + payload)
    head[1:1] = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _name(refers_to))]
    return _member(head, http)


def _revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat an earlier one's
    payload. Only ids and digests move, and a digest's first page is a partial
    minimum, so a payload that a third of the pages share stays cheap."""
    marks = pages.where(F.octet_length("html") >= LEAST_BYTES).select(
        "page_id", F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("digest"))
    first = written(marks.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"), "firsts")  # stored, so that a digest's rows may be split in the join
    return (marks.join(first, "digest").where(F.col("page_id") > F.col("refers_to"))
            .select("page_id", "digest", "refers_to").distinct())


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) to gzip
    WARC files in ``folder``; returns (path, bytes, records), a row per file.

    Null html is an empty payload. Rows that share page_id and payload are
    written each, all as responses if theirs is the first. A null page_id
    gets a record without a number, never a revisit. An empty table writes
    no file. A task that runs again replaces its own file.
    """
    small_batches(pages.sparkSession, 256)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    marked = rows.withColumn("digest", F.unhex(F.sha2(F.col("html").cast("binary"), 256))).join(
        _revisits(rows), ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/pages-{TaskContext.get().partitionId():07d}.warc.gz"
        out = system = None
        size = n = 0
        for part in slices(batches, "html"):
            if out is None:
                system, name = store(path)
                system.create_dir(name.rpartition("/")[0], recursive=True)
                part_name = f"{name}.{TaskContext.get().taskAttemptId()}.part"
                out = system.open_output_stream(part_name)
            for page, url, html, refers in zip(*(part.column(c).to_pylist() for c in
                                                 ("page_id", "url", "html", "refers_to"))):
                payload = html.encode()
                raw = record(page, url, payload, sha256(payload).hexdigest(), refers)
                out.write(raw)
                size, n = size + len(raw), n + 1
        if out is not None:
            out.close()
            system.move(part_name, name)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()),
                                              pa.array([n], pa.int64())], names=["path", "bytes", "records"])
    return written(marked.select("page_id", "url", "html", "refers_to").mapInArrow(
        run, "path string, bytes long, records long"), "archives")


class _Window:
    """A file's bytes from some place on, read as they are asked for."""

    def __init__(self, file: fs.NativeFile, at: int):
        self.file, self.start, self.held = file, at, b""

    def more(self) -> bool:
        chunk = self.file.read_at(READ_BYTES, self.start + len(self.held))
        self.held += chunk
        return bool(chunk)

    def forget(self, upto: int) -> None:
        self.held, self.start = self.held[upto - self.start:], upto


def _inflate(window: _Window, at: int, header_only: bool) -> tuple[bytes, int] | None:
    """(content, place after it) of the member at ``at``, or None if there is
    none; with ``header_only`` up to the end of the record's header, however
    long it is: bytes that open with a version line are a record's."""
    coder, out, fed = zlib.decompressobj(31), [], at - window.start
    total, seen = bytearray(), 0
    try:
        while not coder.eof:
            if fed >= len(window.held) and not window.more():
                return None
            chunk = window.held[fed:fed + READ_BYTES] if not header_only else window.held[fed:fed + 4096]
            fed += len(chunk)
            out.append(coder.decompress(chunk))
            if header_only:
                total.extend(out.pop())
                if len(total) >= len(VERSION) and not OPENING.match(total):
                    return None
                if total.find(b"\r\n\r\n", max(0, seen - 3)) >= 0:
                    return bytes(total), 0
                seen = len(total)
    except zlib.error:
        return None
    if header_only:
        return None
    return b"".join(out), window.start + fed - len(coder.unused_data)


def members(file: fs.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """Contents of the records that start at bytes ``start`` to ``end``."""
    window, at, trusted = _Window(file, start), start, False
    while at < end:
        if not trusted:
            while True:  # the next magic bytes, which may lie across two reads
                place = window.held.find(MAGIC, at - window.start)
                if place >= 0:
                    break
                at = max(at, window.start + len(window.held) - len(MAGIC) + 1)
                window.forget(at)
                if at >= end or not window.more():
                    return
            at = window.start + place
            if at >= end:
                return
            if _inflate(window, at, True) is None:
                at += 1
                continue
        found = _inflate(window, at, False)
        if found is None:  # damaged, or the file's end
            if trusted:
                trusted = False
                continue
            at += 1
            continue
        content, at = found
        yield content
        window.forget(at)
        trusted = bool(window.held) or window.more()
        if not trusted:
            return
        trusted = window.held.startswith(MAGIC)


def parse(content: bytes) -> dict:
    """Header fields (lower-case names; a folded line goes on with its field)
    and ``block`` of a record; without a length the block is all that follows."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields: dict = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last is not None:
            fields[last] += " " + line.strip()
            continue
        key, _, value = line.partition(":")
        last = key.strip().lower()
        fields[last] = value.strip()
    length = fields.get("content-length", "")
    fields["block"] = rest[:int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    return fields


def _stated(digest: str | None, payload: bytes) -> bool | None:
    """Whether the payload has the digest that a header states; None where it
    states none, or by a function that isn't known here."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5", "sha512"):
        return None
    found = hashlib.new(kind.lower(), payload).digest()
    return value.strip().lower() in (found.hex(), base64.b32encode(found).decode().rstrip("=").lower(),
                                     base64.b32encode(found).decode().lower())


def splits(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end): each file in ranges of at most ``split_bytes``."""
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                  F.lit(split_bytes).cast("long")))
    return archives.select("path", places.alias("start"), "bytes").select(
        "path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("intact", pa.bool_())])


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row for each record of the files in ``archives`` (path, bytes): page_id,
    url, payload_bytes, payload_digest, record_type, refers_to, and ``intact``,
    whether its payload has the length and digest that its header states.

    Archives of other writers are read too, of any version: every record is a
    row, with its own type (warcinfo, request, ...), the digest is worked out
    from the payload, and what their headers don't say is null (page_id and
    refers_to, which are this writer's names, and a revisit's length)."""
    ranges = splits(archives, split_bytes)
    n = max(1, min(ranges.count(), 4 * partitions(archives.sparkSession)))

    def number(name: str | None) -> int | None:
        digits = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
        return int(digits[1]) if digits else None

    def row(content: bytes) -> dict:
        r = parse(content)
        kind, stated, intact = r.get("warc-type", ""), r.get("warc-payload-digest"), True
        own = number(r.get("warc-record-id")) is not None or r.get("warc-record-id") == _name(None)
        length = r.get("warc-payload-length", "")
        size = int(length) if length.isdigit() else None
        if kind == "revisit":  # its payload is elsewhere: what the header says of it
            digest = stated.partition(":")[2].strip().lower() if (stated or "").lower().startswith("sha256:") else None
        else:
            http = r.get("content-type", "").replace(" ", "").startswith("application/http")
            payload = r["block"].partition(b"\r\n\r\n")[2] if http else r["block"]
            intact = size in (None, len(payload)) and _stated(stated, payload) is not False
            size, digest = len(payload), sha256(payload).hexdigest()
        uri = r.get("warc-target-uri")
        if own and uri is not None:
            uri = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), uri)
        return {"page_id": number(r.get("warc-record-id")), "url": uri, "payload_bytes": size,
                "payload_digest": digest, "record_type": kind, "refers_to": number(r.get("warc-refers-to")),
                "intact": intact}

    def run(batches):
        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                system, name = store(path)
                rows = []
                with system.open_input_file(name) as file:
                    for content in members(file, start, end):
                        rows.append(row(content))
                        if len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)
    return (ranges.repartition(n, "path", "start").mapInArrow(run, (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, intact boolean")))


def round_trip(pages: DataFrame) -> DataFrame:
    """:func:`write` to a fresh shared folder, then :func:`read`."""
    spark: SparkSession = pages.sparkSession
    return read(write(pages, scratch_path(spark, "warc")))
