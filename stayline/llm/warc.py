"""WARC archives written index first, and read back by coalesced byte ranges.

Each task writes one archive: every record is a gzip member of its own, so that it can be read alone. The writer's result is
the index, one row per record: archive, offset, length, url, digest. Of records with equal payloads the one with the
smallest page id is stored as ``response``; the others are ``revisit`` records that name it and hold no payload.

Reading takes any selection of index rows, sorts it by archive and offset, joins ranges that lie close together into one
read, and decodes the records inside. Archives are opened through the file system of their folder's URI, not a local path.
A retried task writes an archive under a new name and its index rows name that one; a lost attempt's file is never read.

Nulls: a null html is an empty payload, a null url leaves out the target header, a null page id is kept as null and never is the
response that others revisit. Repeated rows of the smallest page id are each a response. Payloads below ``least`` bytes are
always stored. Empty tables give an empty index and no archive. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import session
from stayline.llm.scratch import stage

INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, verified boolean"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    """A url on one header line: control characters and the percent sign are percent-coded."""
    return "".join(c if c >= " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in url)


def _url(uri: str) -> str:
    parts = uri.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def encode(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, level: int = 1) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return b"".join((packer.compress(head), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()))


def _headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def _page(urn: str | None) -> int | None:
    value = urn[len("<urn:page:") : -1] if urn else "None"
    return None if value == "None" else int(value)


def decode(member: bytes) -> dict:
    """The fields of a record, with ``payload`` (None for a revisit)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = warc["WARC-Type"] == "revisit"
    size = int(_headers(http)["Content-Length"])
    found = named if revisit else sha1_base32(payload)
    return {
        "page_id": _page(warc["WARC-Record-ID"]), "url": _url(warc["WARC-Target-URI"]) if "WARC-Target-URI" in warc else None,
        "record_type": warc["WARC-Type"], "refers_to": _page(warc.get("WARC-Refers-To")), "payload_bytes": size,
        "payload_digest": found, "verified": found == named and (revisit or len(payload) == size), "payload": None if revisit else payload,
    }


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: the page whose payload a row repeats, null if its own is stored.

    Only ids and digests are grouped; the pages themselves are shuffled once, by id and digest, which no group of copies makes hot.
    """
    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("warc_sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    small = plain.filter(F.octet_length("html") >= least).select("page_id", "warc_sha")
    firsts = small.groupBy("warc_sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    revisits = small.join(firsts, "warc_sha").filter("page_id is null or page_id > refers_to").filter("refers_to is not null").distinct()
    other = revisits.select(F.col("page_id").alias("warc_page"), F.col("warc_sha").alias("warc_other"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("warc_page")) & (F.col("warc_sha") == F.col("warc_other"))
    return plain.join(other, same, "left").select("page_id", "url", "html", "refers_to")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's URI with scheme and host, as Spark itself would open it: a bare path belongs to the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toUri()
    return f"{uri.getScheme()}://{uri.getRawAuthority() or ''}{uri.getRawPath()}"


def write(pages: DataFrame, root: str | None = None, least: int = 0, level: int = 1) -> DataFrame:
    """Archive all pages under ``root`` (a path or URI of any form that Hadoop takes; by default a new folder of the shared one) and return the index."""
    spark = pages.sparkSession
    root = root or session.scratch_path(spark, "warc")
    uri = qualified(spark, root)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        out, at, system, folder = None, 0, *fs.FileSystem.from_uri(uri)
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(folder, recursive=True)
                        out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    payload = row["html"].encode()
                    digest = sha1_base32(payload)
                    record = encode(row["page_id"], row["url"], payload, digest, row["refers_to"], level)
                    out.write(record)
                    rows.append((f"{uri}/{name}", at, len(record), row["page_id"], row["url"], digest, len(payload), "response" if row["refers_to"] is None else "revisit", row["refers_to"]))
                    at += len(record)
                yield _batch(rows, _INDEX)
        finally:
            if out is not None:
                out.close()

    return stage(mark_revisits(pages, least).mapInArrow(archive, INDEX), "warc-index")


_INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])
_RECORD = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("verified", pa.bool_()),
]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def joined_ranges(offsets: list[int], lengths: list[int], gap: int, most: int) -> Iterator[tuple[int, int]]:
    """First and last (exclusive) position in sorted ranges that one read covers."""
    start = 0
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or offsets[i] - offsets[i - 1] - lengths[i - 1] > gap or offsets[i] + lengths[i] - offsets[start] > most:
            yield start, i
            start = i


def read(index: DataFrame, payload: bool = False, gap: int = 1 << 16, most: int = 1 << 22, task_bytes: int = 1 << 25) -> DataFrame:
    """The records of index rows (all, or any selection), with their payload as ``html`` on request.

    Ranges up to ``gap`` bytes apart are read together, up to ``most`` bytes at once. A task
    reads about ``task_bytes``; the few bytes of an index row say nothing about the bytes it points to.
    """
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // task_bytes) or 1
    kinds = pa.schema([*_RECORD, *([("html", pa.string())] if payload else [])])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            files, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            start = 0
            while start < len(files):
                end = start
                while end < len(files) and files[end] == files[start]:
                    end += 1
                if files[start] != name:
                    if handle:
                        handle.close()
                    name = files[start]
                    system, path = fs.FileSystem.from_uri(name)
                    handle = system.open_input_file(path)
                for a, b in joined_ranges(offsets[start:end], lengths[start:end], gap, most):
                    first = offsets[start + a]
                    piece = handle.read_at(offsets[start + b - 1] + lengths[start + b - 1] - first, first)
                    rows = []
                    for i in range(start + a, start + b):
                        at = offsets[i] - first
                        r = decode(piece[at : at + lengths[i]])
                        rows.append(tuple(r[n] for n, _ in _RECORD) + ((None if r["payload"] is None else r["payload"].decode(),) if payload else ()))
                    yield _batch(rows, kinds)
                start = end
        if handle:
            handle.close()

    chosen = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return chosen.mapInArrow(fetch, RECORD + (", html string" if payload else ""))
