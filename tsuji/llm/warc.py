"""WARC archives: written with an index first, read back by coalesced byte ranges of the index.

Writing: every task writes its records, each its own gzip member, to a file of its own below the
shared scratch folder and returns one index row per record: file, offset, length, URL, payload
digest, record type. The index is a committed table, so files of failed attempts are never read.
Reading: the selected index rows are range-sorted by file and offset; a task reads neighbouring
records with one ranged read and parses them.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id holds the
payload (``response``), the others refer to it (``revisit``); smaller payloads are always stored.

Defined cases: a null payload is an empty one; rows that repeat the largest id are all responses; a
null id sorts below all others and is written without the id field; a null URL is left out; columns
beyond id, URL and payload are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import arrow_fs, scratch_path
from .common import prepared, written

FILE_BYTES = 1 << 30           # an archive file is closed beyond this size
READ_BYTES = 8 << 20           # neighbouring records are read together up to this size
GAP_BYTES = 64 << 10           # and across gaps up to this size
TASK_BYTES = 8 << 20           # compressed bytes per reading task
DATE = "1970-01-01T00:00:00Z"

INDEX = "file string, offset long, length long, url string, digest string, id long, type string"
RECORD = "id long, url string, type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _escaped(url: str) -> str:
    """Control characters, blanks at the ends and percent signs may not stand in a header line."""
    return re.sub(r"[\x00-\x1f\x7f%\x85  ]|^ | $", lambda m: quote(m[0], safe=""), url)


def record(page_id, url, payload: bytes, refers_to, is_revisit: bool, date: str = DATE) -> tuple[bytes, str]:
    """(one WARC record, payload digest). A revisit keeps the HTTP head and leaves the payload out."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if is_revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """The fields of one record; a response's payload digest is recomputed and must agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError("payload and digest differ")
    number = lambda k: int(field[k]) if k in field else None
    url = field.get("WARC-Target-URI")
    return {"id": number("Page-ID"), "url": None if url is None else unquote(url), "type": field["WARC-Type"],
            "refers_to": number("Refers-To-Page-ID"), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if field["WARC-Type"] == "response" else None}


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write the archives below ``folder`` (shared storage); returns the index, itself a written table.

    Only digests of payloads that occur more than once are joined back, so pages are shuffled only
    when those do not fit a broadcast; a digest that a third of all pages share is one row there."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    repeated = (rows.where(F.col("size") >= min_bytes).groupBy("sha", "size")
                .agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    marked = rows.join(repeated, ["sha", "size"], "left")
    is_revisit = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("id"))
    marked = marked.select("id", "url", "payload", F.when(is_revisit, F.col("holder")).alias("refers_to"),
                           is_revisit.alias("revisit"))

    def run(batches):
        fs, base = arrow_fs(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for r in range(batch.num_rows):
                    page_id, url, payload, refers_to, revisit = (batch.column(c)[r].as_py() for c in range(5))
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    raw, digest = record(page_id, url, payload, refers_to, revisit)
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    index.append((name, at, len(member), url, digest, page_id, "revisit" if revisit else "response"))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index), _INDEX_ARROW)] if index else [pa.array([], t) for t in _INDEX_ARROW],
                    names=[x.split()[0] for x in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return written(prepared(marked).mapInArrow(run, INDEX), "warc-index")


_INDEX_ARROW = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
_RECORD_ARROW = {"id": pa.int64(), "url": pa.string(), "type": pa.string(), "refers_to": pa.int64(),
                 "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}


def ranges(rows, read_bytes: int = READ_BYTES, gap: int = GAP_BYTES):
    """Group (file, offset, length) rows, sorted, into (file, begin, end, rows) reads."""
    group, file, begin, end = [], None, 0, 0
    for name, offset, length in rows:
        near = name == file and 0 <= offset - end <= gap and offset + length - begin <= read_bytes
        if group and not near:
            yield file, begin, end, group
            group = []
        if not group:
            file, begin = name, offset
        group.append((offset, length))
        end = offset + length
    if group:
        yield file, begin, end, group


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the given index rows. Pass a filtered index to read a selection."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    chosen = (index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
              .sortWithinPartitions("file", "offset"))
    names = [n for n in _RECORD_ARROW if payloads or n != "payload"]

    def run(batches):
        fs, base = arrow_fs(folder)
        rows = ((f.as_py(), o.as_py(), n.as_py()) for b in batches for f, o, n in zip(b.column(0), b.column(1), b.column(2)))
        source, opened = None, None
        for file, begin, end, group in ranges(rows):
            if opened != file:
                if source is not None:
                    source.close()
                source, opened = fs.open_input_file(f"{base}/{file}"), file
            data = source.read_at(end - begin, begin)
            found = [parse(zlib.decompress(data[o - begin:o - begin + n], 31)) for o, n in group]
            for at in range(0, len(found), 256):
                part = found[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in part], _RECORD_ARROW[n]) for n in names], names=names)
        if source is not None:
            source.close()

    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    return prepared(chosen).mapInArrow(run, schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write every page, read all records back."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write(pages, folder)
    return read(index, folder, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
