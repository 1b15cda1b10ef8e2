"""WARC archives: writing records with revisits, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import shuffle_cleanup
from tidewatch.session import scratch_dir

VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
ENDING = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Records of an archive; a reader holds one archive at a time.
ARCHIVE_RECORDS = 2000
#: Bytes that are handed to the inflater at a time.
CHUNK = 1 << 16
#: Copies of the "newest page of a payload" table that a much repeated payload is dealt over.
SALTS = 64
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(raw: bytes) -> bytes:
    """One gzip member, without time or name: equal records give equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit leaves the payload out and names the record that has it."""
    block = HTTP + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + ENDING


@dataclass
class Salvaged:
    """What one file holds: records (place, headers, block) in order, and gaps (start, end, reason) that no record covers."""

    records: list[tuple[int, dict[str, str], bytes]] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)

    def skip(self, start: int, end: int, reason: str) -> None:
        if start < end:
            if self.gaps and self.gaps[-1][1] == start:
                start, _, reason = self.gaps.pop()
            self.gaps.append((start, end, reason))


class Damaged(ValueError):
    pass


def parse_record(raw: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``; Damaged if its version line, headers, length, ending or digest is wrong."""
    if not raw.startswith(VERSION, at):
        raise Damaged("no version line")
    stop = raw.find(ENDING, at)
    if stop < 0:
        raise Damaged("headers do not end")
    headers: dict[str, str] = {}
    for line in raw[at + len(VERSION) : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without colon")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "surrogatepass" if b"\xed" in value else "replace")
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no length")
    start, end = stop + len(ENDING), stop + len(ENDING) + int(length)
    if raw[end : end + len(ENDING)] != ENDING:
        raise Damaged("record does not end at its length")
    block = raw[start:end]
    if headers.get("warc-type") == "response" and "warc-payload-digest" in headers:
        if headers["warc-payload-digest"].removeprefix("sha1:") != digest(payload_of(block)):
            raise Damaged("digest differs")
    return headers, block, end + len(ENDING)


def payload_of(block: bytes) -> bytes:
    return block.partition(ENDING)[2]


def inflate(raw: bytes, at: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at ``at``; Damaged if it does not inflate, ends early or fails its checksum."""
    unpacker, view, parts = zlib.decompressobj(31), memoryview(raw), []
    # In chunks: what a member leaves unused is copied, and must not be the rest of the archive.
    while not unpacker.eof and at < len(raw):
        chunk = view[at : at + CHUNK]
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error as error:
            raise Damaged(str(error)) from error
        at += len(chunk)
    if not unpacker.eof:
        raise Damaged("member does not end")
    return b"".join(parts), at - len(unpacker.unused_data)


def salvage(raw: bytes) -> Salvaged:
    """Read all records of an archive, plain or with gzip members, around any damage.

    After a check fails, the search goes on one byte later for the next gzip magic or version line that starts a
    valid member or record; what lies between is logged as a gap. A member whose checksum holds but whose content is not made of records is
    logged as a gap too, its good records are kept.
    """
    found, at, end = Salvaged(), 0, len(raw)
    while at < end:
        try:
            if raw.startswith(MAGIC, at):
                content, after = inflate(raw, at)
                inner = salvage(content) if content else Salvaged()
                found.records += [(at, headers, block) for _, headers, block in inner.records]
                for a, b, reason in inner.gaps:
                    found.skip(at, after, f"bytes {a} to {b} of the member: {reason}")
                    break
            else:
                headers, block, after = parse_record(raw, at)
                found.records.append((at, headers, block))
            at = after
        except Damaged as error:
            spots = [p for p in (raw.find(MAGIC, at + 1), raw.find(VERSION, at + 1)) if p >= 0]
            following = min(spots, default=end)
            found.skip(at, following, str(error))
            at = following
    return found


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``.

    Of the records with an equal payload of at least ``min_bytes`` bytes, the one with the largest page_id is the response and the
    others revisit it. A null id is smaller than any; rows that share the largest id, and all rows if no id is known, are responses.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload").cast("long"), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")})
    newest = (
        rows.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).filter("n > 1 and newest is not null")
        .select("sha", "size", "newest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    older = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(newest, ["sha", "size", "salt"], "left").select(
        "page_id", "url", "payload", "size", "sha",
        F.when(older, "revisit").otherwise("response").alias("record_type"),
        F.when(older, F.col("newest")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records: int = ARCHIVE_RECORDS) -> None:
    """Write one gzip member per record to archives of at most ``records`` records below ``path``.

    Spark's text sink writes them, so any file system will do and a lost task leaves nothing behind; its line separator is an
    empty gzip member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [member(record(kind, page, url, body, digest(body), to)) for page, url, body, kind, to in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    typed = with_record_types(pages, min_bytes).select("page_id", "url", "payload", "record_type", "refers_to")
    members = typed.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("member"))
    with shuffle_cleanup(pages.sparkSession):
        members.write.option("encoding", "ISO-8859-1").option("lineSep", member(b"").decode("latin1")).option("maxRecordsPerFile", records).text(path)


def _salvaged(spark: SparkSession, path: str, schema: str, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield pa.RecordBatch.from_pylist(rows(file, salvage(content.as_buffer().to_pybytes())), schema=arrow)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: archive, place, page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to.

    Damaged stretches are left out, see ``quarantine``. Null payload for revisits.
    """

    def rows(file: str, found: Salvaged) -> list[dict]:
        out = []
        for at, headers, block in found.records:
            kind = headers.get("warc-type")
            body = payload_of(block) if kind == "response" else None
            size = headers.get("x-payload-length", "")
            out.append({
                "archive": file, "place": at, "page_id": page(headers.get("warc-record-id")), "url": headers.get("warc-target-uri"), "record_type": kind, "payload": body,
                "payload_bytes": len(body) if body is not None else int(size) if size.isascii() and size.isdigit() else None,
                "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:"), "refers_to": page(headers.get("warc-refers-to")),
            })
        return out

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number.lstrip("-").isdigit() and number.isascii() else None

    return _salvaged(spark, path, "archive string, place long, page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long", rows)


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The byte gaps of all archives below ``path``: archive, start, end, reason."""
    return _salvaged(spark, path, "archive string, start long, end long, reason string", lambda file, found: [{"archive": file, "start": a, "end": b, "reason": r} for a, b, r in found.gaps])


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload, a null url an empty one; repeated rows are records of their own; an empty table gives
    no rows. Extra columns are ignored.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
