"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.session import scratch_path

#: Spark's setting that removes the shuffle files of an execution at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Upper-case ASCII letters to lower case, every other byte unchanged.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """ASCII-lower-cased words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text (null: none)."""
    return text.translate(LOWER_ASCII).split() if text else []


def text_bytes(col: str) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` under a name that reads as what it is here: one streaming pass over each partition."""
    return df.mapInArrow(fn, schema)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Python tuples of some columns of a batch."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


class Scratch:
    """Tables written to the cluster's shared folder, dropped by name or when the session ends.

    Every table is written by Spark's own commit protocol, so it survives the
    loss of any executor and cuts the lineage of what reads it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)
        _OPEN.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = (), tidy: bool = False,
             codec: str | None = None) -> DataFrame:
        """Write ``df`` once and return the reading of it.

        ``tidy`` has Spark delete the write's shuffle files when it is done, not
        when the driver next collects garbage.  ``codec`` is Parquet's compression, if not the session's.
        """
        before = self.spark.conf.get(TIDY)
        if tidy:
            self.spark.conf.set(TIDY, "true")
        try:
            (df.write.mode("overwrite").partitionBy(*partition_by) if partition_by
             else df.write.mode("overwrite")).parquet(self.path(name), compression=codec)
        finally:
            self.spark.conf.set(TIDY, before)
        fields = [f for f in df.schema.fields if f.name not in partition_by]
        schema = T.StructType(fields + [df.schema[c] for c in partition_by])
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            _delete(self.spark, self.path(name))

    def release(self) -> None:
        """Let the driver notice now that finished jobs' shuffle files are needed no more (it deletes them then)."""
        gc.collect()
        self.spark._jvm.System.gc()

    def close(self) -> None:
        _delete(self.spark, self.root)


_OPEN: list[Scratch] = []


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def close_all() -> None:
    """Delete every scratch folder of this process (also run at exit while the session lives)."""
    while _OPEN:
        s = _OPEN.pop()
        if s.spark.sparkContext._jsc is not None:
            s.close()


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already; nothing left to do then
        close_all()


def hadoop_to_local(uri: str) -> str:
    """``file:/x`` and ``file:///x`` as a plain path; other URIs unchanged."""
    return re.sub(r"^file:/+", "/", uri)
