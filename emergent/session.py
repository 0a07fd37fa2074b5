"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "emergent", driver_memory: str = "16g") -> SparkSession:
    """A local[N] session configured like a cluster job (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used for reliable checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir).  A session of one machine that has none (``local`` master)
    gets a private folder; any other session without one is an error: a folder
    of one machine would not be seen by the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="emergent-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


#: Tables written by ``reliable`` in this process, in order.
_WRITTEN: list[tuple[SparkSession, str]] = []


def written() -> int:
    """A mark for ``release``: how many tables have been written so far."""
    return len(_WRITTEN)


def release(since: int = 0) -> None:
    """Delete the tables written after a mark; whoever still reads them must be done."""
    while len(_WRITTEN) > since:
        spark, path = _WRITTEN.pop()
        if spark.sparkContext._jsc is None:
            continue
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def reliable(df: DataFrame, name: str = "stage", spread: bool = False,
             partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Cut lineage by writing a Parquet table to the shared checkpoint folder and reading it back.

    One job (an RDD ``checkpoint()`` of an unpersisted plan computes it twice),
    columnar and compressed, and the re-read table carries file-size
    statistics, so later joins against it are planned as broadcasts only when
    it is small.  The files live in the cluster's shared folder, so the table
    survives the loss of any executor.

    ``spread=True`` rebalances the rows first (AQE sizes the partitions by
    their bytes), for tables that later fan out (exploded item sets).
    ``partition_by`` writes directory partitions, so readers filtering on those
    columns prune whole folders.  ``release`` deletes what was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.append((spark, path))
    if spread:
        df = df.hint("rebalance")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # The schema is known: passing it skips the footer-reading inference job.
    schema = df.schema
    if partition_by:
        keep = [f for f in schema.fields if f.name not in partition_by]
        schema = T.StructType(keep + [schema[c] for c in partition_by])
    return spark.read.schema(schema).parquet(path)
