"""WARC archives, index first.

Writing: each task writes the records of its rows one after the other into
archive files of its own (one gzip member per record), and returns an index
row per record: file, offset, length, URL, digest and type.  Spark stores the
index, so only files of committed task attempts are ever referenced; a retried
task writes under new names.  Reading: index rows are selected, sorted by file
and offset, neighbouring byte ranges are joined into one read, and each member
is parsed and its payload held against its digest.

Of records with equal payloads the one with the smallest page id is the
response and the others revisit it, without a payload of their own.  Equality
is decided by SHA-256 and length before anything is written; payloads shorter
than ``least_bytes`` are always responses.

A payload is held in memory by the task that writes or reads it, however long it
is.  A null payload is empty; a null URL or id leaves its header line out, and null
ids sort last.  Rows that repeat both id and payload can't be told apart and
have the same type.  An empty table gives an empty index and result.  Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import broadcast_if_small, materialized
from leadlens.session import checkpoint_dir

#: A file is closed once it has so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Ranges no further apart are read at once, up to so many bytes.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: A reading task gets so many bytes of records, more where that would take more than so many tasks.
STRETCH_BYTES, MAX_TASKS = 8 << 20, 20_000
#: Revisits (id, hash, id: some 100 bytes each) up to this number are broadcast, which leaves the pages where they are.
MAX_BROADCAST_REVISITS = 200_000
DATE = "2001-01-01T00:00:00Z"

INDEX = ("file string, offset long, length long, page_id long, url string, payload_digest string, "
         "record_type string")
PAGES = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, payload string")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str) -> str:
    """A URL as a header value: control characters are escaped."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 else c for c in text)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, kind: str,
                 date: str = DATE) -> tuple[bytes, str]:
    """One WARC record as a gzip member, and its payload digest."""
    mark = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {mark}')}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{mark}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {mark}')}>",
                  f"Refers-To-Page-ID: {refers_to}"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(whole) + z.flush(), mark


def parse_record(member: bytes) -> dict:
    """The fields of one gzip member; raises if the payload isn't what its digest says."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    mark, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != mark):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda k: int(fields[k]) if fields.get(k, "None") != "None" else None
    return {"page_id": number("Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": mark, "record_type": kind, "refers_to": number("Refers-To-Page-ID"),
            "payload": payload.decode() if kind == "response" else None}


def planned(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, html, first_id): first_id is null for responses."""
    html = F.coalesce("html", F.lit(""))
    narrow = pages.select("page_id", F.sha2(html, 256).alias("key"), F.octet_length(html).alias("size"))
    long_enough = narrow.where(F.col("size") >= least_bytes)
    first = (long_enough.groupBy("key", "size").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    revisits = materialized(
        long_enough.join(first, ["key", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("again_id"), F.col("key").alias("again_key"), "first_id").distinct(),
        "revisits")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("key"))
    return rows.join(broadcast_if_small(revisits, MAX_BROADCAST_REVISITS),
                     F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("key") == F.col("again_key")),
                     "left").select("page_id", "url", "html", "first_id",
                                    F.col("again_key").isNotNull().alias("again"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives into ``folder`` (any store that pyarrow reaches); return the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
                            ("record_type", pa.string())])
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None:
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    kind = "revisit" if r["again"] else "response"
                    member, mark = record_bytes(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"),
                                                r["first_id"], kind)
                    out.write(member)
                    rows.append({"file": name, "offset": at, "length": len(member), "page_id": r["page_id"],
                                 "url": r["url"], "payload_digest": mark, "record_type": kind})
                    at += len(member)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if out is not None:
                out.close()

    return materialized(planned(pages, least_bytes).mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str, payloads: bool = True, stretch: int = STRETCH_BYTES) -> DataFrame:
    """The records that ``index`` (any selection of its rows) names, read by joined byte ranges.

    Rows are dealt out by file and stretch of the file, so one large archive is read by many tasks: one per
    ``stretch`` bytes of the selected records, and of longer stretches beyond ``MAX_TASKS``.  The number is given
    explicitly, because index rows are short and Spark would join their partitions by size.
    ``payloads=False`` checks the payloads and leaves them out of the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.string())])
        source, opened = None, None

        def read(name, ranges):
            nonlocal source, opened
            if name != opened:
                if source is not None:
                    source.close()
                source, opened = store.open_input_file(f"{path}/{name}"), name
            start = ranges[0][0]
            source.seek(start)
            data = source.read(ranges[-1][0] + ranges[-1][1] - start)
            found = [parse_record(data[o - start:o - start + n]) for o, n in ranges]
            if not payloads:
                found = [r | {"payload": None} for r in found]
            return pa.RecordBatch.from_pylist(found, schema=schema)

        name, ranges = None, []
        for batch in batches:
            cols = batch.to_pydict()
            for f, o, n in zip(cols["file"], cols["offset"], cols["length"], strict=True):
                if ranges and (f != name or o - sum(ranges[-1]) > GAP_BYTES or o + n - ranges[0][0] > READ_BYTES):
                    yield read(name, ranges)
                    ranges = []
                name = f
                ranges.append((o, n))
        if ranges:
            yield read(name, ranges)
        if source is not None:
            source.close()

    total = index.agg(F.sum("length")).first()[0] or 0
    stretch = max(stretch, -(-total // MAX_TASKS))
    part = F.floor(F.col("offset") / stretch)
    rows = (index.select("file", "offset", "length").repartition(max(1, -(-total // stretch)), "file", part)
            .sortWithinPartitions("file", "offset"))
    return rows.mapInArrow(run, PAGES)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
