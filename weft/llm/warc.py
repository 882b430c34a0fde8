"""WARC writing and splittable reading.

Writing: one gzip member per record. Reading: a task scans its byte range for the gzip magic,
decodes the header of each candidate member, and owns the records that start inside the range.
Archives lie in the shared folder and are reached through ``pyarrow.fs`` (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import drop_written, shared_dir, text_or_empty, written

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
#: Tasks that read archives, at most.
READERS = 100_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(uri: str):
    """(file system, path) of a URI; pyarrow opens each scheme."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(uri)


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}.items())
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def _uri(url: str | None) -> str:
    """A header value: line breaks can't stand in one."""
    return "".join(" " if c in "\r\n" else c for c in url or "")


def http_block(payload: bytes | None, length: int) -> bytes:
    """An HTTP response; a revisit has the header alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    return head + (payload or b"")


def write_warc(df: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write one record per row; returns a table of archives (path, bytes, records), written before it returns.

    Among rows with equal payloads (SHA-1) of at least ``min_bytes`` bytes, that of the smallest id
    is a response and the others are revisits that name it, repetitions of its own id among them;
    shorter ones are all responses. A null payload is empty; a null URL is an empty target; a row with a null id
    can only be a response if no equal payload has an id. An empty table gives no archives. Only the
    three named columns are read. A task writes an archive of its own name, so that a repeated task
    leaves an unlisted file, never a doubled record.
    """
    spark = df.sparkSession
    folder = folder or shared_dir(spark)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), text_or_empty(body_col).cast("binary").alias("body"))
    hashed = src.select("id", F.sha1("body").alias("sha"), F.octet_length("body").alias("n"))
    # Only ids and digests are shuffled here; the partial minimum tames large groups of copies.
    first = hashed.filter(F.col("n") >= min_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    # copies of one payload meet in this join, with slim rows of (id, digest): the hot ones are sent apart.
    hot = first.orderBy(F.desc("copies")).limit(1000).select("sha", "first")
    cold = first.join(hot.select("sha"), "sha", "left_anti").select("sha", "first")
    near = hashed.join(F.broadcast(hot.withColumnRenamed("first", "h")), "sha", "left")
    refs = near.filter("h is not null").select("id", "sha", F.col("h").alias("first")).unionByName(near.filter("h is null").select("id", "sha").join(cold, "sha").select("id", "sha", "first"))
    refs = refs.groupBy("id", "sha").agg(F.min("first").alias("first"), F.count("*").alias("n")).filter("not (id <=> first) or n > 1")
    refs = written(refs, "refs")
    rows = src.withColumn("sha", F.sha1("body")).alias("s").join(refs.alias("r"), F.expr("s.id <=> r.id and s.sha = r.sha"), "left").select("s.id", "s.url", "s.body", "s.sha", F.col("r.first").alias("first"))
    if not refs.filter("id = first").isEmpty():
        # Repeated rows of a response's own id: one of them is the response.
        again = rows.filter("id = first").withColumn("k", F.row_number().over(Window.partitionBy("id", "sha").orderBy("url")))
        rows = rows.filter("first is null or id is null or id <> first").unionByName(again.withColumn("first", F.when(F.col("k") > 1, F.col("first"))).drop("k"))
    rows = rows.drop("sha")

    def write(batches):
        fs = out = path = None
        size = n = 0
        for b in batches:
            for rid, url, body, ref in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(path, compression=None)
                kind = "response" if ref is None else "revisit"
                fields = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Target-URI": _uri(url), "WARC-Payload-Digest": "sha1:" + digest(body), "WARC-Page-ID": "" if rid is None else str(rid), "WARC-Payload-Length": str(len(body)), "Content-Type": "application/http; msgtype=response"}
                if ref is not None:
                    fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To-Page-ID": str(ref)}
                data = record(kind, fields, http_block(None if ref is not None else body, len(body)))
                out.write(data)
                size += len(data)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": pa.array([size], pa.int64()), "records": pa.array([n], pa.int64())})

    files = written(rows.mapInArrow(write, "path string, bytes long, records long"), "archives")
    drop_written(refs)
    # Paths are as the file system names them; the reader wants the scheme of the folder.
    parts = urlparse(folder)
    return files if parts.scheme in ("", "file") else files.withColumn("path", F.concat(F.lit(f"{parts.scheme}://"), "path"))


def member_at(f, start: int, size: int):
    """(WARC header fields, block, end) of the gzip member at ``start``, or None if there is none.

    The header is decoded first: bytes that only look like a member fail there, before much is read.
    """
    z, plain, at = zlib.decompressobj(31), bytearray(), start
    head = None
    try:
        while not z.eof:
            f.seek(at)
            data = f.read(min(CHUNK if head else 4096, size - at))
            if not data:
                return None
            at += len(data)
            plain += z.decompress(data)
            if head is None and (len(plain) >= 5 or z.eof):
                if not plain.startswith(b"WARC/"):
                    return None
                head = True
        at -= len(z.unused_data)
    except zlib.error:
        return None
    top, mark, block = bytes(plain).partition(b"\r\n\r\n")
    if not mark:
        return None
    fields = {}
    for line in top.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    n = number(fields.get("content-length"))
    return (fields, block[:n], at) if n is not None and 0 <= n <= len(block) else None


def number(text: str | None) -> int | None:
    """A header's number that fits 64 bits; null for anything else."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def records_in(f, size: int, lo: int, hi: int):
    """(start, fields, block, end) of records whose members start in [lo, hi): found by magic, checked by decoding, then chained."""
    at, buf, base = lo, b"", lo
    while at < hi:
        if not (base <= at and at + 3 <= base + len(buf)):
            f.seek(at)
            base, buf = at, f.read(min(CHUNK, size - at))
            if len(buf) < 3:
                return
        k = buf.find(MAGIC, at - base)
        if k < 0:
            at = base + len(buf) - 2
            if base + len(buf) >= size:
                return
            continue
        at = base + k
        if at >= hi:
            return
        got = member_at(f, at, size)
        if got is None:
            at += 1
            continue
        yield at, got[0], got[1], got[2]
        at = got[2]


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """Read archives (a table with path and bytes) by byte ranges of ``split_bytes``.

    Returns one row per record: path, offset, record_type, url, page_id, refers_to, payload_digest
    (bare, by the header), payload_length (of the full payload, by the header), payload (null for
    revisits) and payload_sha1 (of the payload read, bare). Header numbers that aren't numbers are null.
    Bytes between members, members whose length is no number, and bytes that only look like members
    are passed over. A record belongs to the range in which its member starts. A payload may itself
    hold members, even in plain bytes: a first pass finds where each range's last member ends, and a
    range is read from the farthest end before it, so what lies inside a member is no record. No
    archives give no rows.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = files.select("path", F.col("bytes").alias("size"), F.explode(starts).alias("lo"))
    # So many tasks, dealt out evenly: the rows say little of the bytes behind them.
    n = files.agg(F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / split_bytes))).first()[0]
    n = max(1, min(READERS, int(n or 1)))

    def ends(batches):
        for b in batches:
            out = []
            for path, size, lo in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, name = filesystem(path)
                with fs.open_input_file(name) as f:
                    out.append(max((end for *_, end in records_in(f, size, lo, min(lo + split_bytes, size))), default=0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], ["path", "size", "lo", "last"])

    def read(batches):
        for b in batches:
            for path, size, lo, after in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, name = filesystem(path)
                rows, held = [], 0
                with fs.open_input_file(name) as f:
                    for at, h, block, _ in records_in(f, size, max(lo, after or 0), min(lo + split_bytes, size)):
                        kind = h.get("warc-type", "")
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        rows.append((path, at, kind, h.get("warc-target-uri", ""), number(h.get("warc-page-id")), number(h.get("warc-refers-to-page-id")), h.get("warc-payload-digest", "").removeprefix("sha1:"), number(h.get("warc-payload-length")), payload, None if payload is None else digest(payload)))
                        held += len(block)
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    found = written(ranges.repartition(n).mapInArrow(ends, "path string, size long, lo long, last long"), "ends")
    before = Window.partitionBy("path").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    ranges = found.select("path", "size", "lo", F.max("last").over(before).alias("after"))
    return ranges.repartition(n).mapInArrow(read, "path string, offset long, record_type string, url string, page_id long, refers_to long, payload_digest string, payload_length long, payload binary, payload_sha1 string")


def _batch(rows):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    names = ["path", "offset", "record_type", "url", "page_id", "refers_to", "payload_digest", "payload_length", "payload", "payload_sha1"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write the rows as WARC, read them back: id, payload_bytes, payload_digest, record_type, refers_to.

    Bytes and digest of a response are taken from the payload that was read, those of a revisit from
    its header (its payload is the response's). Nulls, empty and repeated rows: see write_warc.
    """
    back = read_warc(df.sparkSession, write_warc(df, id_col, url_col, body_col))
    size = F.coalesce(F.octet_length("payload").cast("long"), "payload_length")
    return back.select(F.col("page_id").alias(id_col), size.alias("payload_bytes"), F.coalesce("payload_sha1", "payload_digest").alias("payload_digest"), "record_type", "refers_to")
