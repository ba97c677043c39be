"""WARC archives: a writer, and a salvage reader that recovers what follows damage (operator 1).

Writer. One record per page, compressed as a gzip member of its own. Pages of
equal payloads of MIN_REVISIT bytes or more are written once, as the response
of the largest page id; the others are revisit records that refer to it. Files
are written by Spark's text sink as raw bytes; records are separated by an
empty gzip member (members simply follow each other in a .warc.gz file).

Reader. Each archive is read in one task, record by record. A gzip member must
decompress with its checksum, a record must have a version line, well-formed
headers, a block of the stated length and, if stated, the stated digest. Where
a check fails the reader searches for the next valid member or version line
with a valid record, whichever is nearer (inside a member the latter), goes on
from there, and logs the bytes between as quarantined. Of a broken member the
records in front of the break are kept, if their digests hold.

Archives are read whole, so their size bounds a task's memory: the writer
keeps them near ARCHIVE_BYTES of payload; split larger ones before reading.

Defined results
  null or empty payload     a response of 0 bytes
  very long payload         one record of any length; an archive holds at least one record
  equal largest ids         all rows of the largest id are responses; null ids refer to the largest id, and are
                            responses where every id of the payload is null
  repeated rows             one record each
  empty tables              no records; an empty folder reads as no rows
  extra columns             are not read
  damage                    rows of kind ``gap`` with path, offset, length and reason
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.llm.common import lean, settle
from switchboard.session import fresh_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20
MAX_HEAD = 1 << 20               # longer headers are damage
MAGIC = b"\x1f\x8b\x08"
CUT_OFF = "member is cut off"
#: A gzip member without content: the separator between records in the files.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" "0300" "00000000" "00000000")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- reading ----

def head_ends(data: bytes) -> Callable[[int], int]:
    """A function from a place to the next end of headers, or -1; it remembers that end for the places before it, so
    that a search from every version line of damaged bytes reads them once."""
    start, end = 0, -2

    def find(at: int) -> int:
        nonlocal start, end
        if end == -2 or not (start <= at and (at <= end or end == -1)):
            start, end = at, data.find(b"\r\n\r\n", at)
        return end

    return find


def parse_record(data: bytes, at: int, head_end: Callable[[int], int] | None = None) -> tuple[dict[str, str], bytes, int] | str:
    """(headers, block, end) of the record at ``at``, or the reason why there is none."""
    first = _VERSION.match(data, at)
    if not first:
        return "no version line"
    end = (head_end or head_ends(data))(at)
    if end < 0 or end - at > MAX_HEAD:
        return "headers do not end"
    headers: dict[str, str] = {}
    line_at = first.end()
    while line_at < end:
        # line by line: what is no header ends the attempt before the rest is read
        stop = data.find(b"\r\n", line_at, end + 2)
        line, line_at = data[line_at:stop], stop + 2
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return "malformed header"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        return "no content length"
    start = end + 4
    stop = start + int(length)
    if stop > len(data):
        return "block is cut off"
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "block does not end where stated"
    block = data[start:stop]
    for name in ("warc-block-digest", "warc-payload-digest"):
        stated = headers.get(name)
        if stated and (name == "warc-block-digest" or headers.get("warc-type") in ("resource", "response")):
            body = block if name == "warc-block-digest" else payload_of(headers, block)
            if not _digest_holds(stated, body):
                return "digest differs"
    return headers, block, stop + 4


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP head, where it is an HTTP message."""
    if headers.get("content-type", "").replace(" ", "").startswith("application/http"):
        head = block.find(b"\r\n\r\n")
        return block[head + 4:] if head >= 0 else block
    return block


def _digest_holds(stated: str, body: bytes) -> bool:
    """Check a sha1 digest in hex or base32; digests of other kinds are not checked."""
    kind, _, value = stated.partition(":")
    if kind.lower() != "sha1":
        return True
    digest = hashlib.sha1(body)
    return value.lower() == digest.hexdigest() or value.upper() == base64.b32encode(digest.digest()).decode()


def read_plain(data: bytes) -> Iterator[tuple]:
    """Records and gaps of uncompressed bytes: ("record", offset, length, headers, block) or ("gap", offset, length, reason)."""
    at, bad, reason, head_end = 0, None, "", head_ends(data)
    while at < len(data):
        found = parse_record(data, at, head_end)
        if isinstance(found, str):
            if bad is None:
                bad, reason = at, found
            following = _VERSION.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad is not None:
            yield "gap", bad, at - bad, reason
            bad = None
        headers, block, end = found
        yield "record", at, end - at, headers, block
        at = end
    if bad is not None:
        yield "gap", bad, len(data) - bad, reason


def _member(data: bytes, at: int) -> tuple[bytes, int] | str:
    """(content, end) of the gzip member at ``at``; its checksum and length are checked."""
    engine = zlib.decompressobj(wbits=31)
    out, step = [], at
    try:
        while step < len(data) and not engine.eof:
            out.append(engine.decompress(data[step:step + (1 << 16)]))
            step += 1 << 16
    except zlib.error as error:
        return f"gzip: {error}"
    if not engine.eof:
        return CUT_OFF
    return b"".join(out), min(step, len(data)) - len(engine.unused_data)


def _before_break(data: bytes, at: int) -> bytes:
    """What the broken gzip member at ``at`` gives up to the byte that cannot be decompressed."""
    engine, good = zlib.decompressobj(wbits=31), at
    try:
        while good < len(data):
            engine.decompress(data[good:good + (1 << 16)])
            good += 1 << 16
    except zlib.error:
        pass
    # an error loses the output of its whole call: the last step again, byte by byte
    engine = zlib.decompressobj(wbits=31)
    out = [engine.decompress(data[k:k + (1 << 16)]) for k in range(at, good, 1 << 16)]
    try:
        for k in range(good, min(good + (1 << 16), len(data))):
            out.append(engine.decompress(data[k:k + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _salvaged(content: bytes, reason: str) -> Iterator[tuple]:
    """Sound records in front of the break of a member. Its checksum cannot vouch for them, so a digest must, unless the
    file merely ends early; and other bytes must follow, as a member of one record stands or falls with its checksum."""
    for x in read_plain(content):
        if x[0] == "record" and x[1] + x[2] < len(content) and (reason == CUT_OFF or any(
                x[3].get(name, "").lower().startswith("sha1:") for name in ("warc-block-digest", "warc-payload-digest"))):
            yield x


def read_archive(data: bytes) -> Iterator[tuple]:
    """Records and gaps of an archive of gzip members, plain records or both; offsets are those of the file.

    After a failed check the nearer of the next gzip magic and the next version line is tried.
    """
    at, bad, reason, head_end = 0, None, "", head_ends(data)
    magic = version = -1
    while at < len(data):
        zipped = data.startswith(MAGIC, at)
        found = _member(data, at) if zipped else parse_record(data, at, head_end)
        inside = list(read_plain(found[0])) if zipped and not isinstance(found, str) else []
        if isinstance(found, str) or (inside and all(x[0] == "gap" for x in inside)):
            if bad is None:
                bad, reason = at, found if isinstance(found, str) else inside[0][3]
            if magic <= at:
                magic = data.find(MAGIC, at + 1) % (len(data) + 1)
            content, seen = _before_break(data, at) if zipped and isinstance(found, str) else b"", 0
            while version <= at or seen:
                line = _VERSION.search(data, max(at, version) + 1)
                version = line.start() if line else len(data)
                # bytes that a broken member stores as they are belong to it
                end = head_end(version) if line and head_end(version) - version <= MAX_HEAD else -1
                seen = content.find(data[version:end + 4], seen) + 1 if line and content and end >= 0 else 0
            # after a sound member go on behind it; after a failed check at the next start
            following = min(magic, version) if isinstance(found, str) else found[1]
            for x in _salvaged(content, found) if content else ():
                yield (x[0], at, following - at, *x[3:])
            at = following
            continue
        if bad is not None:
            yield "gap", bad, at - bad, reason
            bad = None
        if zipped:
            for x in inside:
                # part of a member: the whole member is the place in the file
                yield (x[0], at, found[1] - at, *x[3:])
            at = found[1]
        else:
            headers, block, end = found
            yield "record", at, end - at, headers, block
            at = end
    if bad is not None:
        yield "gap", bad, len(data) - bad, reason


_FIELDS = [("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
           ("reason", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
           ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
           ("payload", pa.binary())]
_READ_SQL = ("path string, kind string, offset long, length long, reason string, warc_type string, record_id string, "
             "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary")


def _row(path: str, x: tuple, with_payload: bool) -> tuple:
    if x[0] == "gap":
        return path, "gap", x[1], x[2], x[3], *[None] * 7
    headers, block = x[3], x[4]
    kind = headers.get("warc-type")
    payload = payload_of(headers, block) if kind != "revisit" else None
    digest = hashlib.sha1(payload).hexdigest() if payload is not None else headers.get("warc-payload-digest", "").partition(
        ":")[2].lower()
    return (path, "record", x[1], x[2], None, kind, headers.get("warc-record-id"), headers.get("warc-refers-to"),
            headers.get("warc-target-uri"), digest, None if payload is None else len(payload),
            payload if with_payload else None)


def _read_batches(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for x in read_archive(content.as_py()):
                    rows.append(_row(path.as_py(), x, with_payload))
                    held += len(x[4]) if with_payload and x[0] == "record" else 0
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return lean(read)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], schema=pa.schema(_FIELDS))


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record or quarantined gap of every file in ``folder``."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_read_batches(with_payload), _READ_SQL)


# ---- writing ----

@lean
def _member_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for head, payload in zip(batch.column("head"), batch.column("payload")):
            engine = zlib.compressobj(6, zlib.DEFLATED, 31)
            parts = [engine.compress(head.as_py().encode()), engine.compress(payload.as_py()),
                     engine.compress(b"\r\n\r\n"), engine.flush()]
            out.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])


def _record_id(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def write_archives(pages: DataFrame, folder: str | None = None) -> str:
    """Write a record per row of ``pages`` (page_id, url, html); returns the folder."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    marks = settle(own.select("page_id", F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("sha")),
                   "warc-marks")
    groups = settle(marks.where(F.col("bytes") >= MIN_REVISIT).groupBy("sha", "bytes").agg(
        F.max("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1 AND first IS NOT NULL").select(
        "sha", "first"), "warc-groups")
    revisits = settle(marks.join(groups, "sha").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "first").distinct(), "warc-revisits")
    mean = marks.agg(F.avg("bytes")).first()[0] or 0
    joined = own.join(revisits, own["page_id"].eqNullSafe(F.col("_id")) & (F.sha2("payload", 256) == F.col("_sha")), "left")
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    # header values stay on one line
    url = F.regexp_replace(F.col("url"), r"[\r\n]+", " ")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"))
    members = joined.select(head.alias("head"), block.alias("payload")).mapInArrow(_member_batches, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES // max(1.0, mean)))).text(folder))
    return folder


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of read page records; a revisit's payload is that of
    the record it refers to, whose digest must be the stated one."""
    def page(c: str):
        return F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) AS BIGINT)")

    rows = records.where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes",
        "payload_digest", F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"))
    rows = settle(rows, "warc-records")
    responses = rows.where("record_type = 'response'").select(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).distinct()
    revisits = rows.where("record_type = 'revisit'").join(
        settle(responses, "warc-responses"), (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("record_type = 'response'").select(columns).unionByName(
        revisits.withColumn("payload_bytes", F.col("_bytes")).select(columns))
