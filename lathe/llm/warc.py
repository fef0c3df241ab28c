"""Operator 5: WARC archives, written by tasks and read back by byte range.

Writing: one gzip member per record, one archive per task, in a shared folder.
Of pages with equal payloads of at least ``min_revisit`` bytes, the one with
the largest id is a response and the others are revisits that refer to it.

Reading needs no index: archives are split into byte ranges, each task looks
for the gzip magic in its range, accepts a candidate when the member decodes to
a WARC version line and header block, and owns the records that start inside
its range (reading on past the end for the last one).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import open_folder, shared_folder, table

VERSION = b"WARC/1.1"      # fixed values of the format
MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT = 1000
SPLIT = 16 << 20
READ = 1 << 20
BITE = 1 << 14
_FOUND = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                    ("payload", pa.binary())])


def _header(pairs) -> bytes:
    return b"".join(name + b": " + value + b"\r\n" for name, value in pairs)


def _clean(value: str | None) -> bytes:
    """A header value holds no line breaks: they are percent-encoded."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A").encode()


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record as a gzip member.  A revisit keeps the HTTP header, with
    the payload's length, and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\n" + _header([(b"Content-Type", b"text/html; charset=utf-8"),
                                             (b"Content-Length", b"%d" % len(payload))]) + b"\r\n"
    body = http if revisit else http + payload
    pairs = [(b"WARC-Type", b"revisit" if revisit else b"response"),
             (b"WARC-Record-ID", b"<urn:page:%s>" % (b"" if page_id is None else b"%d" % page_id)),
             (b"WARC-Date", b"1970-01-01T00:00:00Z"),
             (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
             (b"Content-Type", b"application/http; msgtype=response"),
             (b"Content-Length", b"%d" % len(body))]
    if url is not None:
        pairs.append((b"WARC-Target-URI", _clean(url)))
    if revisit:
        pairs.append((b"WARC-Refers-To", b"<urn:page:%d>" % refers_to))
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(VERSION + b"\r\n" + _header(pairs) + b"\r\n" + body + b"\r\n\r\n") + deflate.flush()


def _write(folder: str, min_revisit: int):
    def run(batches):
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        name = f"{path}/part-{uuid.uuid4().hex}.warc.gz"  # one of its own for every attempt
        size = 0
        with fs.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    page_id, url, payload, digest, largest = row
                    revisit = len(payload) >= min_revisit and largest is not None and page_id != largest
                    member = record(page_id, url, payload, digest, largest, revisit)
                    out.write(member)
                    size += len(member)
        if size:
            yield pa.RecordBatch.from_pydict({"path": [name.rsplit("/", 1)[1]], "size": [size]})
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archives; returns their (path, size) rows, the list that names
    the archives of successful tasks only."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    big = F.octet_length("payload") >= min_revisit
    # payloads that occur once need no entry; the aggregate meets before the shuffle
    largest = (base.where(big).groupBy("digest").agg(F.max("id").alias("largest"), F.count("*").alias("n"))
               .where("n > 1").select("digest", "largest"))
    return (base.join(largest, "digest", "left").select("id", "url", "payload", "digest", "largest")
            .mapInArrow(_write(folder, min_revisit), "path string, size long"))


def _member(data: bytes, at: int, stream):
    """Decode the gzip member at ``at`` of ``data``, reading on from the stream
    where it ends: (content, end, data), content None if it isn't a record."""
    inflate = zlib.decompressobj(31)
    out, pos, checked = bytearray(), at, False
    while True:
        if pos >= len(data):
            more = stream.read(READ)
            if not more:
                return None, at, data
            data += more
        part = data[pos:pos + BITE]
        try:
            out += inflate.decompress(part)
        except zlib.error:
            return None, at, data
        pos += len(part)
        if not checked and len(out) >= len(VERSION):
            if not out.startswith(VERSION[:5]):
                return None, at, data
            checked = True
        if inflate.eof:
            good = checked and b"\r\n\r\n" in out
            return (bytes(out) if good else None), pos - len(inflate.unused_data), data


def _fields(block: bytes) -> dict[bytes, bytes]:
    lines = block.split(b"\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines if x)}


def _page(urn: bytes | None):
    number = (urn or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def _parse(raw: bytes, with_payload: bool) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    body = rest[:int(fields[b"content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = fields[b"warc-type"].decode()
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if b"sha1:" + digest.encode() != fields[b"warc-payload-digest"]:
            raise ValueError("a record's payload does not match its digest")
    else:
        size = int(_fields(http)[b"content-length"])
        digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    url = fields.get(b"warc-target-uri")
    return {"page_id": _page(fields[b"warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": _page(fields.get(b"warc-refers-to")),
            "url": None if url is None else url.decode(),
            "payload": payload if with_payload and kind == "response" else None}


def _records(stream, start: int, end: int):
    """Decoded members that start in [start, end) of an open archive."""
    stream.seek(start)
    data, base, at = b"", start, 0
    while True:
        found = data.find(MAGIC, at)
        if found < 0:
            keep = max(at, len(data) - len(MAGIC) + 1)
            more = stream.read(READ) if base + keep < end else b""
            if not more:
                return
            data, base, at = data[keep:] + more, base + keep, 0
        elif base + found >= end:
            return
        else:
            content, stop, data = _member(data, found, stream)
            at = found + 1 if content is None else stop
            if content is not None:
                yield content


def _read(folder: str, with_payload: bool):
    def run(batches):
        fs, path = open_folder(folder)
        for batch in batches:
            for name, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{path}/{name}") as stream:
                    rows, held = [], 0
                    for raw in _records(stream, start, end):
                        rows.append(_parse(raw, with_payload))
                        held += len(raw) if with_payload else 100
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)
    return run


def read_warc(archives: DataFrame, folder: str, split: int = SPLIT, with_payload: bool = False) -> DataFrame:
    """Records of the archives named by (path, size) rows; one row per record,
    read in tasks of ``split`` bytes each."""
    spark = archives.sparkSession
    ranges = archives.withColumn("start", F.explode(F.expr(f"sequence(0L, size - 1, {split}L)")))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split, "size").alias("end"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return (ranges.repartition(tasks, "path", "start")
            .mapInArrow(_read(folder, with_payload),
                        "page_id long, payload_bytes long, payload_digest string, record_type string, "
                        "refers_to long, url string, payload binary"))


def warc_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write every page, then read the archives back.

    A null payload is an empty one; equal payloads under the size limit are all
    responses; pages that share the largest id of equal payloads are all
    responses; a null id is kept as null and never referred to (equal payloads
    that all have null ids are all responses); an empty table writes no
    archive and gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    archives = write_warc(pages, folder, **columns)
    listing = shared_folder(spark, "warc-list")
    archives.write.parquet(listing)  # written once: the archives of these attempts are the ones to read
    return read_warc(spark.read.parquet(listing), folder)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
