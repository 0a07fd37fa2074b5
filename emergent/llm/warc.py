"""Web archives: records written with an index, repeated payloads as revisits, reads by coalesced ranges.

Every record is a gzip member of its own.  The index has one row per record:
file, offset, length, URL, digest, and whether it is a response or a revisit.
Of records with equal payloads (by SHA-1) of at least ``least_bytes`` bytes the
one with the smallest page id holds the payload; the others refer to it.

Defined results: a null page is an empty payload; a null URL gets a URN of its
page id; line breaks and blanks in a URL are percent-encoded; repeated rows of
the page with the smallest id are responses each; a null id is written as
``null`` and never chosen while another has the payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of, text_bytes
from emergent.llm.ranges import Part, by_place, coalesced

#: Fixed value: the profile of revisits found by an equal payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, url string, digest string, record_type string, page_id long"


def _record(page: int | None, url: str, payload: bytes, digest: bytes, first: int | None, date: str) -> bytes:
    """One record; ``first`` is the page that holds the payload, if another."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if first is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(df: DataFrame, scratch: Scratch, *, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
                   file_bytes: int = 1 << 30, level: int = 4) -> DataFrame:
    """Write an archive record per row; returns the saved index table."""
    folder = scratch.path("archives")
    src = (df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     text_bytes(payload_col).alias("payload"))
           .withColumn("digest", F.sha1("payload")))
    # Digests that occur more than once; a small table beside the payloads, combined before it is shuffled.
    firsts = (src.filter(F.length("payload") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    marked = src.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", F.unhex("digest").alias("digest"),
        F.when((F.length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")),
               F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), None
        for b in batches:
            made: list[tuple] = []
            for page, url, payload, digest, first in rows_of(b, "page_id", "url", "payload", "digest", "first"):
                if part is None or part.at >= file_bytes:
                    if part:
                        part.close()
                    part = Part(folder, ".warc.gz", shard)
                url = quote(url, safe=_URL_SAFE) if url is not None else f"urn:page:{page}"
                gz = zlib.compressobj(level, wbits=31)
                data = gz.compress(_record(page, url, payload, digest, first, date)) + gz.flush()
                made.append((part.uri, part.at, len(data), url, base64.b32encode(digest).decode(),
                             "response" if first is None else "revisit", page))
                part.write(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 7, _INDEX_TYPES)],
                names=_INDEX_NAMES)
        if part:
            part.close()

    return scratch.save(arrow_map(marked, run, INDEX), "index")


_INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
#: Printable characters that stay as they are in a target URI; blanks, controls and non-ASCII are encoded.
_URL_SAFE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _parse(data: bytes) -> tuple:
    """``(page_id, record_type, url, digest, payload bytes, refers_to, payload)`` of a record."""
    record = zlib.decompress(data, wbits=31)
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size
                               or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not fit its digest")
    number = lambda x: None if x in (None, "<urn:page:null>") else int(x[len("<urn:page:"):-1])
    return (number(fields["WARC-Record-ID"]), kind, fields["WARC-Target-URI"], digest, size,
            number(fields.get("WARC-Refers-To")), payload if kind == "response" else None)


def read_archives(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that the index rows name (all, or any selection of them), read by coalesced ranges.

    Columns: page_id, record_type, url, payload_digest, payload_bytes,
    refers_to, and the payload (null for revisits) if asked for.
    """
    src = by_place(index, "file", "offset", "length")
    names = ["page_id", "record_type", "url", "payload_digest", "payload_bytes", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    keep = 7 if with_payload else 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(got: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)][:keep],
                                              names=names[:keep])

        for b in batches:
            got, size = [], 0
            for _, data in coalesced((f, o, n, None) for f, o, n in rows_of(b, "file", "offset", "length")):
                got.append(_parse(bytes(data)))
                size += len(data)
                if size > 4 << 20:
                    yield out(got)
                    got, size = [], 0
            if got:
                yield out(got)

    schema = "page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long"
    return arrow_map(src, run, schema + ", payload binary" * with_payload)
