"""Binary files in the shared folder: written by tasks, read back by coalesced byte ranges."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import hadoop_to_local


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file URI (``file:``, ``hdfs:``, ``s3:``, ``gs:``)."""
    uri = hadoop_to_local(uri)
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


#: Bytes of files that a task reads back.
READ_BYTES = 32 << 20


def by_place(index: DataFrame, *columns: str) -> DataFrame:
    """Index rows dealt by file and offset to as many tasks as their records' bytes need, in order.

    The rows are small whatever they point at, so the number of tasks comes from
    the sum of the lengths, not from the size of the rows.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    return (index.select(*columns).repartitionByRange(max(1, -(-size // READ_BYTES)), "file", "offset")
            .sortWithinPartitions("file", "offset"))


class Part:
    """One task attempt's output file; its name is unique, so a retried task never meets a half-written one.

    Only names that the index table holds count; Spark commits that table with
    the rows of successful attempts alone.
    """

    def __init__(self, folder: str, suffix: str, number: int):
        self.uri = f"{folder}/part-{number:05d}-{uuid.uuid4().hex}{suffix}"
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path, compression=None)
        self.at = 0

    def write(self, data: bytes | pa.Buffer) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.out.close()


def coalesced(rows: Iterable[tuple[str, int, int, Any]], gap: int = 64 << 10,
              most: int = 8 << 20) -> Iterator[tuple[Any, memoryview]]:
    """``(tag, bytes)`` per ``(file, offset, length, tag)``, given in order of file and offset.

    Neighbouring ranges at most ``gap`` bytes apart become one read, of ``most``
    bytes or a single longer record, so memory stays bounded.
    """
    run: list[tuple[str, int, int, Any]] = []
    opened: list[Any] = ["", None]

    def read() -> Iterator[tuple[Any, memoryview]]:
        if not run:
            return
        if opened[0] != run[0][0]:
            if opened[1]:
                opened[1].close()
            store, path = open_store(run[0][0])
            opened[:] = [run[0][0], store.open_input_file(path)]
        start = run[0][1]
        end = max(o + n for _, o, n, _ in run)
        data = memoryview(opened[1].read_at(end - start, start))
        for _, o, n, tag in run:
            yield tag, data[o - start:o - start + n]

    for row in rows:
        if run and (row[0] != run[0][0] or row[1] > run[-1][1] + run[-1][2] + gap
                    or row[1] + row[2] - run[0][1] > most):
            yield from read()
            run = []
        run.append(row)
    yield from read()
    if opened[1]:
        opened[1].close()
