"""WARC archives, index first.

Each page is one record, compressed as a gzip member of its own. While a task writes its
archive it notes the offset, length, URL and digest of every record; this index is a table
that Spark commits, and only what it names exists: a task that is lost and run again leaves an
orphan archive and no other trace. To read, select rows of the index; the records of an
archive are sorted by offset, ranges that lie close are coalesced into one read, and every
payload is held against its digest.

Of equal payloads of at least ``least_bytes`` bytes the page with the largest id is a response
and the others are revisits that refer to it; smaller payloads are all responses. Repeated
rows of the response's page are responses too. A null page is an empty payload; pages without
an id are responses and refer to none. A null URL is left out of the record. An empty table
gives an empty index. Folders may be any that pyarrow's file systems open and all executors
share. Only the id, URL and page columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, filesystem

#: An archive that has reached this size is closed and the next one begun.
ARCHIVE_BYTES = 1 << 28
#: Ranges that lie this close, in bytes, are read at once, up to the most.
READ_GAP, READ_MOST = 1 << 16, 1 << 23
#: Bytes of an archive that one task reads.
TASK_BYTES = 1 << 23
#: Records that a batch returns.
RETURNED = 256
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
PAYLOAD = ", payload binary"
INDEX = "page_id long, url string, digest string, record_type string, archive string, offset long, length long"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record, not compressed."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record that ``record`` wrote, its payload's length and, of a response, the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != size or _base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda f: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(f, ""))) else None
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "payload": payload if whole else None}


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def archive_batches(batches: Iterator[pa.RecordBatch], folder: str, date: str, level: int) -> Iterator[pa.RecordBatch]:
    """A task's archives: writes the records of batches and yields their index rows."""
    fs, path = filesystem(folder)
    out, name, at = None, "", 0
    for b in batches:
        notes: list[tuple] = []
        for page_id, url, html, sha1, refers_to in zip(*(c.to_pylist() for c in b.columns)):
            if out is None or at >= ARCHIVE_BYTES:
                if out is not None:
                    out.close()
                fs.create_dir(path, recursive=True)
                name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            digest = _base32(bytes.fromhex(sha1))
            member = zlib.compressobj(level, zlib.DEFLATED, 31)
            raw = record(page_id, url, html.encode(), digest, refers_to, date)
            packed = member.compress(raw) + member.flush()
            out.write(packed)
            notes.append((page_id, url, digest, "response" if refers_to is None else "revisit", name, at, len(packed)))
            at += len(packed)
        cols = list(zip(*notes)) if notes else [[]] * 7
        kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=[f.split()[0] for f in INDEX.split(", ")])
    if out is not None:
        out.close()


def write(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", date: str = "2000-01-01T00:00:00Z", level: int = 1) -> DataFrame:
    """Write archives and their index below ``folder``; returns the index as stored."""
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("sha1", F.sha1("html"))
    # Only payloads that occur again can be revisited; their rows are the smaller side.
    again = (rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= least_bytes))
             .groupBy("sha1").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").select("sha1", "kept"))
    known = rows.join(again, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(F.col("page_id") != F.col("kept"), F.col("kept")).alias("refers_to"))

    known.mapInArrow(lambda batches: archive_batches(batches, folder, date, level), INDEX).write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def record_batches(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    """The records at (archive, offset, length), sorted; ranges that lie close are read together."""
    names = [f.split()[0] for f in (RECORD + PAYLOAD * with_payload).split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]
    fs, path = filesystem(folder)
    name, source = None, None
    for b in batches:
        files = b.column(0).to_pylist()
        begin = b.column(1).to_numpy()
        end = begin + b.column(2).to_numpy()
        found: list[dict] = []
        i = 0
        while i < len(files):
            j = i + 1
            while j < len(files) and files[j] == files[i] and begin[j] - end[j - 1] <= READ_GAP and end[j] - begin[i] <= READ_MOST:
                j += 1
            if files[i] != name:
                name, source = files[i], fs.open_input_file(f"{path}/{files[i]}")
            raw = memoryview(source.read_at(int(end[i:j].max() - begin[i]), int(begin[i])))
            for k in range(i, j):
                found.append(parse(zlib.decompress(raw[begin[k] - begin[i]:end[k] - begin[i]], 31)))
                if len(found) == RETURNED:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, kinds)], names=names)
                    found = []
            i = j
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, kinds)], names=names)


def read(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that rows of the index select: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload (null for a revisit)."""
    bounded_batches(selected.sparkSession)
    # A task reads about TASK_BYTES of an archive, however small the index that names them.
    wanted = selected.select("archive", "offset", "length", F.floor(F.col("offset") / TASK_BYTES).alias("part"))
    tasks = math.ceil((wanted.agg(F.sum("length")).first()[0] or 0) / TASK_BYTES)
    return (wanted.repartition(max(1, 2 * tasks), "archive", "part")
            .sortWithinPartitions("archive", "offset").select("archive", "offset", "length")
            .mapInArrow(lambda batches: record_batches(batches, folder, with_payload), RECORD + PAYLOAD * with_payload))
