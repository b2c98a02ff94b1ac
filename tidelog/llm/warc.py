"""WARC archives (operator 1): a writer and a splittable reader.

``write_warc`` writes one gzip member per record.  Every task writes files of its
own under a folder that all executors share; the returned manifest (path, bytes,
records) is stored as a table, so files of lost or repeated tasks are in no
manifest and are never read.

``read_warc`` cuts the files into byte ranges, one task row each.  A task looks
for gzip magic in its range, takes a candidate for a record only if the member
there decodes to a WARC header with the mandatory fields, has a block of the
stated length and passes the gzip checksum, and owns the records whose members
start inside its range (it reads on beyond the end for the last one).  So every
record is read once, whatever the range size.

Equal payloads of at least ``dedup_min_bytes`` bytes are stored once: the record
with the smallest id is a ``response``, the others are ``revisit`` records
(identical-payload-digest profile) that refer to it and keep its HTTP head.

Defined cases: a null payload is the empty payload; a null id is written and read
as null and sorts behind all others (a response); a null URI leaves out the URI
field; line breaks in a URI are percent-encoded; of repeated rows with the
smallest id of their payload all are responses; an empty table gives empty
files, an empty manifest and no records; other input columns are ignored.
A header may be of any length (a URI is not bounded); ``check_counts`` compares the
records read with the manifest.  Memory is bounded by one record and one block of a
file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import stored

FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
BLOCK = 1 << 20
GZIP_LEVEL = 4
MAGIC = b"\x1f\x8b\x08"
ID_PREFIX = "urn:record:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORD = ("path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
          "payload_bytes long, payload_digest string, digest_ok boolean")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- records ----------------------------------------------------------------------

def head(version: str, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [version, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record_urn(value: str | None) -> str:
    return f"<{ID_PREFIX}{'' if value is None else 'id:' + quote(value, safe='')}>"


def urn_value(urn: str | None) -> str | None:
    body = (urn or "").strip("<>").removeprefix(ID_PREFIX)
    return unquote(body[3:]) if body.startswith("id:") else None


def member(record_id, uri, refers_to, digest_hex, payload: bytes, date: str, level: int) -> bytes:
    """One record as a gzip member; ``refers_to`` is the URN value of a revisit, else None."""
    revisit = refers_to is not None
    block = head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"),
                                     ("Content-Length", str(len(payload)))])
    if not revisit:
        block += payload
    warc = head("WARC/1.1", [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_urn(record_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else uri.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_urn(refers_to) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ])
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(warc + block + b"\r\n\r\n") + pack.flush()


# --- writing --------------------------------------------------------------------------

def with_first_ids(rows: DataFrame, dedup_min_bytes: int) -> DataFrame:
    """``rows`` (id, uri, payload, digest) with ``first_id``: the smallest id of equal
    payloads where there are several, else null."""
    first = (rows.filter(F.octet_length("payload") >= dedup_min_bytes)
             .groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first_id"))
    out = rows.join(first, "digest", "left")
    return out.withColumn("first_id", F.when(F.octet_length("payload") >= dedup_min_bytes, F.col("first_id")))


def write_warc(df: DataFrame, folder: str, id_col: str, uri_col: str, payload_col: str, dedup_min_bytes: int = 0,
               date: str = "2024-01-01T00:00:00Z", level: int = GZIP_LEVEL) -> DataFrame:
    """Write a record per row under ``folder`` (a URI that the executors' file system
    library reads, such as file, hdfs or s3); returns the stored manifest."""
    payload = F.col(payload_col)
    if dict(df.dtypes)[payload_col] != "binary":
        payload = F.encode(payload.cast("string"), "UTF-8")
    payload = F.coalesce(payload, F.lit(b""))
    rows = df.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"),
                     payload.alias("payload"), F.sha1(payload).alias("digest"))
    rows = with_first_ids(rows, dedup_min_bytes)
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id")) & F.col("id").isNotNull()
    rows = rows.select(F.col("id").cast("string").alias("id"), "uri", "payload", "digest",
                       F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"))

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("id", "uri", "refers_to", "digest", "payload"))):
                if out is None:
                    name, size, n = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = member(*(v.as_py() for v in row), date, level)
                out.write(data)
                size += len(data)
                n += 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    yield manifest_row(f"{folder}/{name}", size, n)
        if out is not None:
            out.close()
            yield manifest_row(f"{folder}/{name}", size, n)

    return stored(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def manifest_row(path: str, size: int, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                                      ["path", "bytes", "records"])


# --- reading ---------------------------------------------------------------------------

def fields_of(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def read_member(file, at: int, size: int) -> tuple[dict[str, str], bytes, int] | None:
    """(WARC fields, block, offset behind it) of the member at an offset, or None if
    no whole WARC record starts there."""
    unpack, data, position = zlib.decompressobj(31), bytearray(), at
    fields: dict[str, str] = {}
    start = searched = 0
    file.seek(at)
    step = 1 << 12  # little is read of a false candidate
    while not unpack.eof:
        raw = file.read(min(step, size - position))
        if not raw:
            return None
        position += len(raw)
        step = BLOCK
        try:
            data += unpack.decompress(raw)
        except zlib.error:
            return None
        if not start:
            if data[:7] != b"WARC/1."[: len(data[:7])]:
                return None
            behind = data.find(b"\r\n\r\n", searched)
            searched = max(len(data) - 3, 0)  # a header may be of any length
            if behind < 0 and unpack.eof:
                return None
            if behind >= 0:
                fields, start = fields_of(bytes(data[:behind])), behind + 4
                if not (fields.get("content-length", "").isdigit() and "warc-type" in fields
                        and "warc-record-id" in fields):
                    return None
    length = int(fields["content-length"])
    if len(data) != start + length + 4:
        return None
    return fields, bytes(data[start : start + length]), position - len(unpack.unused_data)


def records_in(file, size: int, start: int, end: int):
    """(offset, WARC fields, block) of the records whose members start in [start, end)."""
    at, buffer, base = start, b"", start
    while at < end:
        if not base <= at < base + len(buffer) - len(MAGIC) + 1:
            file.seek(at)
            base, buffer = at, file.read(min(BLOCK, end + len(MAGIC) - 1 - at, size - at))
            if len(buffer) < len(MAGIC):
                return
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            at = base + len(buffer) - len(MAGIC) + 1
            continue
        at = base + found
        if at >= end:
            return
        record = read_member(file, at, size)
        if record is None:  # magic by chance
            at += 1
            continue
        yield at, record[0], record[1]
        at = record[2]


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, int, str]:
    """(payload kept in the record, payload bytes, digest of the full payload)."""
    told = fields.get("warc-payload-digest", "").partition(":")[2]
    http, body = None, block
    if fields.get("content-type", "").startswith("application/http"):
        text, _, body = block.partition(b"\r\n\r\n")
        http = fields_of(text)
    if fields["warc-type"] == "revisit":
        return body, int((http or {}).get("content-length", len(body))), told
    return body, len(body), base32_sha1(body)


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES,
              with_payload: bool = False) -> DataFrame:
    """The records of the files of a manifest (path, bytes).  ``record_id`` and
    ``refers_to`` are the ids that ``write_warc`` was given, as text; ``payload_bytes``
    and ``payload_digest`` are those of the full payload, also for revisits;
    ``digest_ok`` says whether the payload read has the digest that its record states."""
    size = F.col("bytes")
    starts = F.explode(F.when(size > 0, F.sequence(F.lit(0).cast("long"), size - 1, F.lit(split_bytes).cast("long"))))
    ranges = files.select("path", "bytes", starts.alias("start"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = RECORD + (", payload binary" if with_payload else "")

    def read(batches):
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                fs, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for at, fields, block in records_in(file, size, start, min(start + split_bytes, size)):
                        payload, n, digest = payload_of(fields, block)
                        told = fields.get("warc-payload-digest", "").partition(":")[2]
                        rows.append((path, at, fields["warc-type"], urn_value(fields["warc-record-id"]),
                                     fields.get("warc-target-uri"), urn_value(fields.get("warc-refers-to")),
                                     n, digest, told == digest, *([payload] if with_payload else [])))
                        held += len(payload) if with_payload else 200
                        if held > 4 * BLOCK:
                            yield record_batch(rows, with_payload)
                            rows, held = [], 0
                if rows:
                    yield record_batch(rows, with_payload)

    return ranges.repartition(tasks).mapInArrow(read, schema)


def check_counts(records: DataFrame, manifest: DataFrame) -> None:
    """Raise unless as many records were read from each file as its manifest tells."""
    found = records.groupBy("path").agg(F.count("*").alias("found"))
    wrong = (manifest.join(found, "path", "left").withColumn("found", F.coalesce("found", F.lit(0)))
             .filter("found <> records").orderBy("path").first())
    if wrong is not None:
        raise ValueError(f"{wrong['path']}: {wrong['found']} records read, {wrong['records']} written")


def record_batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * with_payload
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)
