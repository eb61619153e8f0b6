"""WARC archives with one Zstandard frame per record and a dictionary up front.

File layout: a skippable frame (magic 0x184D2A5D) that holds the dictionary,
itself a Zstandard frame or plain, or nothing; then one frame per record. Each
task writes files of its own, named by partition and attempt, and reports
them; only files that the report lists are read, so a lost or repeated task
leaves no record twice. Files live in the shared folder and are reached by
pyarrow's file systems (local or mounted paths, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named, materialize, small
from vaultline.session import scratch_path

# fixed values of the formats
DICT_MAGIC, SKIPPABLE = 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC, VERSION = b"\x28\xb5\x2f\xfd", b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:vaultline:page:"

LEAST_SHARED, FILE_BYTES = 100, 64 << 20
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES, LEVEL = 400, 2 << 20, 32 << 10, 3
READ_BYTES, MAX_RECORD = 1 << 20, 2 << 30


def _clean(value: str) -> str:
    """Header values hold no control characters: they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str, fallback: str) -> bytes:
    """One WARC record; a revisit carries the HTTP head only."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = head + payload if refers_to is None else head
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{PAGE_URN}{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:uuid:{fallback}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame, and the dictionary in it; empty where the
    samples are too few to train one."""
    try:
        made = zstandard.train_dictionary(DICT_BYTES, samples)
    except (zstandard.ZstdError, ValueError):
        return struct.pack("<II", DICT_MAGIC, 0), None
    packed = zstandard.ZstdCompressor(level=19).compress(made.as_bytes())
    return struct.pack("<II", DICT_MAGIC, len(packed)) + packed, made


def _writer(root: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        done: list[tuple[str, int, int]] = []
        out = packer = None
        waiting: list[bytes] = []
        state = {"bytes": 0, "records": 0}

        def start():
            nonlocal out, packer
            lead, made = dictionary_frame(waiting)
            file = f"{name}-{len(done):04d}.warc.zst"
            out = system.open_output_stream(f"{folder}/{file}", compression=None)
            out.write(lead)
            packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)
            done.append((f"{root.rstrip('/')}/{file}", 0, 0))
            state.update(bytes=len(lead), records=0)
            for r in waiting:
                put(r)
            waiting.clear()

        def put(data: bytes):
            frame = packer.compress(data)
            out.write(frame)
            state["bytes"] += len(frame)
            state["records"] += 1

        def close():
            nonlocal out
            if waiting:
                start()
            if out is not None:
                out.close()
                done[-1] = (done[-1][0], state["records"], state["bytes"])
                out = None

        held = 0
        for batch in batches:
            for i, (page, url, html, digest, refers) in enumerate(zip(*(batch[c].to_pylist() for c in (
                    "page_id", "url", "payload", "digest", "refers_to")))):
                fallback = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}/{len(done)}/{state['records']}/{len(waiting)}/{i}")
                data = record(page, url, html.encode(), digest, refers, date, str(fallback))
                if out is None:
                    waiting.append(data)
                    held += len(data)
                    if len(waiting) >= SAMPLE_RECORDS or held >= SAMPLE_BYTES:
                        start()
                        held = 0
                else:
                    put(data)
                    if state["bytes"] >= FILE_BYTES:
                        close()
        close()
        if done:
            yield pa.RecordBatch.from_pydict({"path": [x for x, _, _ in done], "records": pa.array([y for _, y, _ in done], pa.int64()),
                                              "bytes": pa.array([z for _, _, z in done], pa.int64())})
    return write


def write_archives(pages: DataFrame, root: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``root``;
    returns the report (path, records, bytes).

    A null html is an empty payload, a null url gives no target URI, and a row
    without an id gets a record id of its own. Rows with equal payloads of
    LEAST_SHARED bytes or more refer to the smallest id among them, whose own
    rows are responses, as are rows without an id and all smaller payloads.
    """
    payload = F.coalesce(column_named(pages, "html").cast("string"), F.lit(""))
    p = pages.select(column_named(pages, "page_id").cast("bigint").alias("page_id"),
                     column_named(pages, "url").cast("string").alias("url"), payload.alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    firsts = materialize(p.filter((F.octet_length("payload") >= LEAST_SHARED) & F.col("page_id").isNotNull())
                         .groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
                         .filter("first < last").select(F.col("digest").alias("d"), "first"), "firsts")
    joined = p.join(small(firsts, 4 * firsts.count()), F.col("digest") == F.col("d"), "left")
    rows = joined.select("page_id", "url", "payload", "digest",
                         F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))
    return materialize(rows.mapInArrow(_writer(root, date), "path string, records bigint, bytes bigint"), "report")


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError("the file ends inside a frame")
    return bytes(data)


def frames(stream) -> Iterator[bytes]:
    """The content of each frame of an archive; other skippable frames are skipped."""
    lead = stream.read(8)
    if not len(lead):
        return
    if len(lead) < 8:
        raise ValueError("the file ends inside a frame")
    magic, size = struct.unpack("<II", lead)
    made, rest = None, b""
    if magic == DICT_MAGIC:
        raw = _exactly(stream, size)
        if raw.startswith(ZSTD_MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
        made = zstandard.ZstdCompressionDict(raw) if raw else None
    else:
        rest = bytes(lead)
    unpacker = zstandard.ZstdDecompressor(dict_data=made) if made else zstandard.ZstdDecompressor()
    while True:
        if len(rest) < 8:
            rest += bytes(stream.read(READ_BYTES))
        if not rest:
            return
        if len(rest) >= 8 and struct.unpack("<I", rest[:4])[0] in SKIPPABLE:
            size = 8 + struct.unpack("<I", rest[4:8])[0]
            rest = rest[size:] if len(rest) >= size else _exactly(stream, size - len(rest))[:0]
            continue
        one, parts, total = unpacker.decompressobj(), [], 0
        while not one.eof:
            if not rest:
                rest = bytes(stream.read(READ_BYTES))
                if not rest:
                    raise ValueError("the file ends inside a frame")
            part, rest = one.decompress(rest), b""
            total += len(part)
            if total > MAX_RECORD:
                raise ValueError("a record is too long")
            parts.append(part)
        rest = one.unused_data
        yield b"".join(parts)


def parsed(data: bytes) -> dict:
    """Fields of one record; ValueError where a header or length is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        raise ValueError("no WARC head")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError("a header line has no name")
        if name.lower() in fields:
            raise ValueError(f"{name} is given twice")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("content-length does not fit the record")
    http, found, payload = rest[:size].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    claimed = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http + b"\r")
    digest = re.fullmatch(r"sha256:([0-9a-f]{64})", fields.get("warc-payload-digest", ""))
    if not digest:
        raise ValueError("no SHA-256 payload digest")
    kind = fields["warc-type"]
    page = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", fields["warc-record-id"])
    refers = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", fields.get("warc-refers-to", ""))
    if kind == "response":
        if claimed and int(claimed[1]) != len(payload):
            raise ValueError("the HTTP length does not fit the payload")
        if hashlib.sha256(payload).hexdigest() != digest[1]:
            raise ValueError("the payload does not fit its digest")
    elif kind == "revisit":
        if payload or not refers or not fields.get("warc-profile"):
            raise ValueError("a revisit has a payload, no target or no profile")
    else:
        raise ValueError(f"unknown type {kind}")
    return {"page_id": int(page[1]) if page else None, "target_uri": fields.get("warc-target-uri"),
            "record_type": kind, "payload_digest": digest[1], "payload": payload if kind == "response" else None,
            "refers_to": int(refers[1]) if refers else None, "error": None}


SCHEMA = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()),
                    ("payload_digest", pa.string()), ("payload", pa.binary()), ("refers_to", pa.int64()),
                    ("error", pa.string()), ("path", pa.string())])
BATCH_BYTES = 4 << 20


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            rows: list[dict] = []
            size = 0
            with system.open_input_stream(name, compression=None) as stream:
                found = frames(stream)
                while True:
                    try:
                        data = next(found)
                    except StopIteration:
                        break
                    except (ValueError, zstandard.ZstdError) as e:   # the rest of the file cannot be cut into frames
                        rows.append({"error": str(e), "path": path})
                        break
                    try:
                        row = parsed(data)
                    except (ValueError, UnicodeDecodeError) as e:
                        row = {"error": str(e)}
                    rows.append(row | {"path": path})
                    size += len(data)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)


def read_archives(spark: SparkSession, report: DataFrame) -> DataFrame:
    """Every record of the files in ``report`` (path): page_id, target_uri,
    record_type, payload_digest, payload, refers_to, error, path. A record that
    breaks a rule is a row with ``error`` and no other fields; a file that ends
    inside a frame gives the records before it and one such row. A file is one
    task, read as a stream."""
    files = report.count()
    paths = report.select("path").repartition(max(files, 1))
    return paths.mapInArrow(_read, "page_id bigint, target_uri string, record_type string, payload_digest string, "
                                   "payload binary, refers_to bigint, error string, path string")


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, error)
    of every row, as read back from archives written to the shared folder. A
    revisit's length is that of the response it refers to."""
    spark = pages.sparkSession
    report = write_archives(pages, scratch_path(spark, "llm-warc"))
    rows = materialize(read_archives(spark, report).select(
        "page_id", F.octet_length("payload").cast("bigint").alias("own_bytes"), "payload_digest", "record_type",
        "refers_to", "error"), "records")
    target = (rows.filter("record_type = 'response' and page_id is not null")
              .groupBy(F.col("page_id").alias("t_id"), F.col("payload_digest").alias("t_digest"))
              .agg(F.max("own_bytes").alias("t_bytes")))
    return rows.join(target, (F.col("refers_to") == F.col("t_id")) & (F.col("payload_digest") == F.col("t_digest")),
                     "left").select("page_id", F.coalesce("own_bytes", "t_bytes").alias("payload_bytes"),
                                    "payload_digest", "record_type", "refers_to", "error")
