"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A record frames one serialized sequence: its length (8 bytes, little-endian),
the masked CRC-32C of those 8 bytes, the sequence, the masked CRC-32C of the
sequence.  The sequence is a small header (document id, whether it has one,
bytes per token id) and the ids, little-endian.

Defined results: a null text is empty and has the end id alone; a null id is
kept as null and sorts first; repeated rows give repeated records; an empty
table gives no file and an empty index.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of
from emergent.llm.crc32c import crc32c, masked
from emergent.llm.ranges import Part, by_place, coalesced
from emergent.llm.tokens import encoder

HEAD = "<q?B2x"
INDEX = ("shard int, file string, offset long, length long, id long, n_tokens long, start long")


def _frame(sequences: list[bytes]) -> Iterator[bytes]:
    """The records of some sequences."""
    sizes = [struct.pack("<Q", len(s)) for s in sequences]
    for size, a, s, b in zip(sizes, masked(crc32c(sizes)).tolist(), sequences, masked(crc32c(sequences)).tolist()):
        yield b"".join((size, struct.pack("<I", a), s, struct.pack("<I", b)))


def _unframe(records: list[bytes]) -> list[bytes]:
    """The sequences of some records; a wrong length or checksum is an error."""
    out = [r[12:-4] for r in records]
    sums = np.array([struct.unpack("<I", r[8:12]) + struct.unpack("<I", r[-4:]) for r in records], dtype=np.uint32)
    if any(struct.unpack("<Q", r[:8])[0] != len(s) for r, s in zip(records, out)):
        raise ValueError("a record's length does not fit")
    if (masked(crc32c([r[:8] for r in records])) != sums[:, 0]).any() or (masked(crc32c(out)) != sums[:, 1]).any():
        raise ValueError("a record's checksum does not fit")
    return out


def write_records(df: DataFrame, scratch: Scratch, *, vocabulary: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", id_bytes: int = 2) -> DataFrame:
    """Encode and write one file per range of ids, in ascending id order; returns the saved index table.

    ``id_bytes`` is 2 where every id is below 65,536, else 4.  ``start`` in the
    index counts the ids before a record in all files.
    """
    folder = scratch.path("records")
    src = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
           .repartitionByRange("id").sortWithinPartitions("id"))
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, part, start = encoder(vocabulary), TaskContext.get().partitionId(), None, 0
        for b in batches:
            ids = b.column(0).to_pylist()
            if ids and part is None:
                part = Part(folder, ".tfrecord", shard)
            made: list[tuple] = []
            for lo in range(0, len(ids), 256):
                some = ids[lo:lo + 256]
                tokens = [np.append(np.frombuffer(t, "<u4"), np.uint32(end_id))
                          for t in encode(x for x, in rows_of(b.slice(lo, 256), "text"))]
                if id_bytes == 2 and max(int(t.max()) for t in tokens) > 0xFFFF:
                    raise ValueError("an id does not fit into 2 bytes")
                heads = [struct.pack(HEAD, i or 0, i is not None, id_bytes) for i in some]
                for i, t, r in zip(some, tokens, _frame([h + t.astype(kind).tobytes()
                                                         for h, t in zip(heads, tokens)])):
                    made.append((shard, part.uri, part.at, len(r), i, len(t), start))
                    part.write(r)
                    start += len(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 7, _INDEX_TYPES)],
                names=_INDEX_NAMES)
        if part:
            part.close()

    local = scratch.save(arrow_map(src, run, INDEX), "local-index")
    # One row per file: its ids, and those of all files before it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = local.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    index = local.join(bases, "shard").withColumn("start", F.col("start") + F.col("base")).drop("base")
    return scratch.save(index, "index")


_INDEX_NAMES = ["shard", "file", "offset", "length", "id", "n_tokens", "start"]
_INDEX_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def read_records(index: DataFrame) -> DataFrame:
    """``(id, start, ids)`` of the index rows given (all, or any selection, in any order); ids as 4-byte integers.

    The rows are dealt by file and offset, so each task's reads coalesce; for a
    shuffled epoch, order the result by any key: only the index was needed.
    """
    src = by_place(index, "file", "offset", "length", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: list[tuple[int, bytes]] = []
            size = 0
            for start, r in coalesced(rows_of(b, "file", "offset", "length", "start")):
                got.append((start, bytes(r)))
                size += len(r)
                if size > 4 << 20:
                    yield _decoded(got)
                    got, size = [], 0
            yield _decoded(got)

    return arrow_map(src, run, "id long, start long, ids binary")


def _decoded(got: list[tuple[int, bytes]]) -> pa.RecordBatch:
    ids, data = [], []
    for s in _unframe([r for _, r in got]) if got else []:
        i, known, width = struct.unpack_from(HEAD, s)
        ids.append(i if known else None)
        data.append(np.frombuffer(s, {2: "<u2", 4: "<u4"}[width], offset=struct.calcsize(HEAD)).astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([s for s, _ in got], pa.int64()), pa.array(data, pa.binary())],
        names=["id", "start", "ids"])


def crc32_of(ids: bytes) -> int:
    """The checksum that the query reports."""
    return zlib.crc32(ids)
