"""Delimited scans with explicit schemas and column pruning."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Texts that the source's reader takes as missing (pass them as ``null_tokens`` to do the same).
SOURCE_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_BAD = "_bad_record"


def _checked(raw: DataFrame, what: str) -> DataFrame:
    """The rows without the bad-record column; a malformed record is an error when it is read, never a lost row."""
    failed = F.raise_error(F.concat(F.lit(f"malformed record in the {what}: "), F.col(_BAD)))
    first = raw.columns[0]
    return raw.withColumn(first, F.when(F.col(_BAD).isNotNull(), failed.cast("string")).otherwise(F.col(f"`{first}`"))) \
        .drop(_BAD)


def _null(c: Column, tokens: Sequence[str]) -> Column:
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c) if tokens else c


def read_label_bridge_tsv(spark: SparkSession, path: str,
                          positions: Sequence[int] = (0, 2, 3),
                          names: Sequence[str] = ("bridge_item", "label_name", "label_key"),
                          sep: str = "\t", comment: str = "#", null_tokens: Sequence[str] = ("",)) -> DataFrame:
    """Headerless, commented TSV; keeps the columns at ``positions`` (they move between releases).

    Quoted fields may hold doubled quotes.  ``null_tokens`` (Q-12) are read as
    null; rows with a null bridge item or label key are dropped (F3); a null
    label name is kept.  Only the columns up to the last wanted position are parsed.
    """
    width = max(positions) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = (spark.read.option("sep", sep).option("comment", comment).option("header", "false")
           .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").schema(schema).csv(path))
    out = raw.select(*[_null(F.col(f"c{p}"), null_tokens).alias(n) for p, n in zip(positions, names)])
    return out.dropna(subset=[names[0], names[2]])


#: Files whose first lines are read at once.
_READERS = 32


def csv_headers(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files that have them in that order, from each file's first line.

    The files are those that the scan lists anyway; of each the driver reads one
    line, in parallel, through the file system that Spark itself uses.  Empty
    files have no columns and are left out.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(uri: str) -> tuple[str, str | None]:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream, codec = place.getFileSystem(conf).open(place), codecs.getCodec(place)
        stream = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return place.toString(), reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(_READERS) as pool:
        lines = list(pool.map(first_line, sorted(spark.read.option("recursiveFileLookup", "true").text(path).inputFiles())))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in lines:
        if line is not None:
            out.setdefault(tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])), []).append(file)
    return out


def read_associations_csv(spark: SparkSession, path: str | Sequence[str],
                          entity: str = "drugbank_id", label: str = "ind_id",
                          label_name: str = "ind_name", status: str = "status",
                          null_tokens: Sequence[str] = ("",), multi_line: bool = False,
                          place: str | None = None) -> DataFrame:
    """S3: CSV files with headers, all columns read as text (no inference), roles renamed.

    Columns go by their names in each file's own header, so files may order them
    differently; a file that lacks a role, or names a column twice, is an error.
    Files of one header are one scan, with its own column pruning.  Quoted fields
    may hold separators and doubled quotes.  A record with too few or too many
    fields is an error.  Records that span lines need ``multi_line=True``; such a
    file is not split.  Columns other than the four roles pass through
    untouched, null where a file does not have them.  ``place`` names a further
    column (file, block, row) that orders the rows as they stand, files by path.
    """
    options = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"',
               "multiLine": str(multi_line).lower()}
    renames = {entity: "entity_id", label: "label_id", label_name: "label_name", status: "status"}
    headers = csv_headers(spark, path)
    out = None
    for columns, files in sorted(headers.items()):
        missing = [c for c in renames if c not in columns]
        if missing or len(set(columns)) < len(columns):
            raise ValueError(f"columns {missing or list(columns)} are missing or repeated in the header of {files[0]}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BAD]])
        raw = (spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, enforceSchema="true")
               .schema(schema).csv(files))
        if place:
            raw = raw.withColumn(place, F.struct("_metadata.file_path", "_metadata.file_block_start",
                                                 F.monotonically_increasing_id().alias("row")))
        part = _checked(raw, "association table").select(
            *[_null(F.col(f"`{c}`"), null_tokens).alias(renames.get(c, c)) for c in columns], *([place] if place else []))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no header in {path}")
    return out
