"""WARC archives: written with an index, read back by coalesced byte ranges.

Each task writes one archive of gzip members, one per record, into a folder that all executors
share, under a name of its own attempt, and returns the index rows (file, offset, length, URL,
digest) only once the file is complete; a lost or repeated attempt leaves a file that no index row
names. The index is a table of its own. Reading takes selected index rows, sorts them by file and
offset, joins neighbouring ranges into single reads, and parses the records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import fresh_path, read, rows_of, written

#: Payloads under this many bytes are always written in full.
LEAST_REVISIT = 1000
#: Ranges closer than the gap are read at once, up to so many bytes; a task reads so many bytes of archives, fewer where cores would have nothing to do, but not under the least.
GAP, READ_BYTES, STRETCH, LEAST_STRETCH = 64 << 10, 4 << 20, 32 << 20, 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long, file string, offset long, length long"


def filesystem(uri: str):
    """A file system that executors reach without Spark, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record: an HTTP response with its payload, or a revisit that has only the response's head."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    target = (url or "").encode("utf-8", "surrogatepass").replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + record_id(page_id).encode(), b"WARC-Target-URI: " + target, b"WARC-Date: " + date.encode(), b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if refers_to is not None:
        lines += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: " + record_id(refers_to).encode()]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's WARC fields, its HTTP fields and its payload."""

    def fields(part: bytes) -> dict[str, str]:
        return {k.decode(): v.decode("utf-8", "surrogatepass") for k, _, v in (x.partition(b": ") for x in part.split(b"\r\n")[1:])}

    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    size = int(warc["Content-Length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"{warc['WARC-Record-ID']}: its block has another length")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http), payload


def packed(data: bytes, level: int = 4) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, path = filesystem(folder)
    name, out, at, rows = f"{uuid4().hex}.warc.gz", None, 0, []
    for page_id, url, html, refers_to in rows_of(batches, "page_id", "url", "html", "refers_to"):
        payload = (html or "").encode("utf-8", "surrogatepass")
        data = packed(record(page_id, url, payload, refers_to))
        out = out or files.open_output_stream(f"{path}/{name}", compression=None)
        out.write(data)
        rows.append((page_id, url, "response" if refers_to is None else "revisit", hashlib.sha1(payload).hexdigest(), len(payload), refers_to, name, at, len(data)))
        at += len(data)
    if out:
        out.close()
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in INDEX.split(", ")]
    for lo in range(0, len(rows), 4096):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 4096], strict=True), kinds, strict=True)], names)


def payload_key():
    """The SHA-256 of a page's payload."""
    return F.sha2(F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8"), 256)


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, key, refers_to: pages and payloads of at least so many bytes that also stand at a larger page_id."""
    size = F.octet_length(F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8"))
    keys = pages.where(F.col("page_id").isNotNull() & (size >= least)).select("page_id", payload_key().alias("key"))
    last = keys.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("key", "refers_to")
    last = written(last, "warc-copies")  # a table of its own, so that a payload of very many copies can be split in the join
    return keys.join(last, "key").where("page_id < refers_to").select("page_id", "key", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT) -> tuple[DataFrame, str]:
    """Writes a record for each row of pages (page_id, url, html); the index and the folder.

    Null html counts as empty, a null url as an empty one. Rows with a null page_id are responses.
    Rows may share a page_id: each is judged by its own payload, and rows that repeat the payload of
    the page_id that others refer to are all responses. Payloads of any length are whole in one
    record, which a task holds in memory one at a time. Other columns are ignored; an empty table
    gives an empty index. The archives go with the operators' other tables (remove_tables).
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    files, path = filesystem(folder)
    files.create_dir(path, recursive=True)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    marked = pages.withColumn("key", payload_key()).join(revisits(pages, least), ["page_id", "key"], "left").drop("key")
    index = marked.mapInArrow(partial(_write_batches, folder=folder), INDEX)
    return written(index, "warc-index"), folder


def _read_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Index rows sorted by file and offset to page_id, url, record_type, digest, payload_bytes, refers_to, payload."""
    files, path = filesystem(folder)
    names = ["page_id", "url", "record_type", "digest", "payload_bytes", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def number(uri: str | None) -> int | None:
        digits = (uri or "")[len("<urn:x-page:") : -1]
        return int(digits) if digits else None

    def fetch(name: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
        with files.open_input_file(f"{path}/{name}") as source:
            source.seek(ranges[0][0])
            data = source.read(ranges[-1][0] + ranges[-1][1] - ranges[0][0])
        rows = []
        for offset, length in ranges:
            at = offset - ranges[0][0]
            warc, http, payload = parse(zlib.decompress(data[at : at + length], 31))
            digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            full = warc["WARC-Type"] == "response"
            if full and hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"{name} at {offset}: the payload doesn't have its digest")
            rows.append((number(warc["WARC-Record-ID"]), warc["WARC-Target-URI"], warc["WARC-Type"], digest, len(payload) if full else int(http["Content-Length"]), number(warc.get("WARC-Refers-To")), payload if full else None))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    name, ranges = None, []
    for file, offset, length in rows_of(batches, "file", "offset", "length"):
        if ranges and (file != name or offset - sum(ranges[-1]) > GAP or offset + length - ranges[0][0] > READ_BYTES):
            yield fetch(name, ranges)
            ranges = []
        name = file
        ranges.append((offset, length))
    if ranges:
        yield fetch(name, ranges)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that index rows select, with payloads (null for revisits), in as many tasks as their archives' bytes ask for: each reads neighbouring records in order."""
    wanted = index.select("file", "offset", "length")
    total = wanted.agg(F.sum("length")).first()[0] or 0
    stretch = max(LEAST_STRETCH, min(STRETCH, total // index.sparkSession.sparkContext.defaultParallelism))
    # A number of its own: by the size of the index rows alone adaptive execution would put all archives into one task.
    dealt = wanted.repartitionByRange(max(1, -(-total // stretch)), "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(partial(_read_batches, folder=folder), "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long, payload binary")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from archives of the whole pages table."""
    index, folder = write_archives(read(spark, sf_dir, "pages"))
    found = read_records(index, folder)
    return found.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE_SQL = """
WITH keyed AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), last AS (
  SELECT body, max(page_id) AS top FROM keyed WHERE octet_length(body) >= 1000 GROUP BY body
)
SELECT k.page_id, CAST(octet_length(k.body) AS BIGINT) AS payload_bytes, sha1(k.body) AS payload_digest,
       CASE WHEN l.top > k.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN l.top > k.page_id THEN l.top END AS refers_to
FROM keyed k LEFT JOIN last l ON k.body = l.body
"""
