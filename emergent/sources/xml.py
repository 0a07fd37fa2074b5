"""Nested entity XML -> (entity_id, entity_name, features, bridge).

Records are found by parallel bracket matching: files are cut anywhere, every
cut-off piece reports its starts and ends of the row tag, a prefix sum over the
pieces gives the nesting depth at each cut, and a record is a stretch between
two points of depth zero, however the file is laid out.  Each record's text is
parsed on the executors by ``from_xml`` (one explicit schema, nothing inferred)
and ``xpath`` (descendants at any depth).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.functions.items import bridge_symbols, feature_tokens

ENTITY_XML_SCHEMA = T.StructType([
    T.StructField("drugbank-id", T.ArrayType(T.StructType([
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_primary", T.StringType()),
    ]))),
    T.StructField("name", T.StringType()),
    T.StructField("targets", T.StructType([
        T.StructField("target", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
        ]))),
    ])),
])


#: Whole comments and CDATA sections, and the marks that begin and end one.
_SECTION = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_BEGIN = r"<!--|<!\[CDATA\["
_END = r"-->|\]\]>"


def _pieces(spark: SparkSession, path: str | Sequence[str], row_tag: str) -> DataFrame:
    """The files cut behind every ``</row_tag``, with what each part says about the nesting.

    ``const`` is 1 or 0 if a comment or CDATA section is surely open or closed
    after the part, else null (then it is as before).  ``ups_0`` and ``down_0``
    count starts and the one possible end of the row tag if the part begins
    outside of a section, ``ups_1`` and ``down_1`` if it begins inside.
    """
    tag = re.escape(row_tag)
    opening = f"<{tag}(?=[\\s/>])"
    empty = opening + "[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*/>"

    def ups(text: Column) -> Column:
        return F.regexp_count(text, F.lit(opening)) - F.regexp_count(text, F.lit(empty))

    parts = spark.read.options(lineSep=f"</{row_tag}", recursiveFileLookup="true").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    marked = F.col("value").rlike(f"{_BEGIN}|{_END}")
    parts = parts.withColumn("_bare", F.when(marked, F.regexp_replace("value", _SECTION, "")).otherwise(F.col("value")))
    # Only a section that the part does not hold whole is left.
    parts = (parts.withColumn("_begin", F.when(marked, F.regexp_instr("_bare", F.lit(_BEGIN))).otherwise(0))
             .withColumn("_end", F.when(marked, F.regexp_instr("_bare", F.lit(_END))).otherwise(0)))
    ends = (F.col("_end") > 0) & ((F.col("_begin") == 0) | (F.col("_end") < F.col("_begin")))
    upto = F.when(F.col("_begin") > 0, F.col("_begin") - 1).otherwise(F.length("_bare"))
    outside = F.col("_bare").substr(F.lit(1), upto)
    inside = F.when(ends, F.col("_bare").substr(F.col("_end") + 3, F.greatest(upto - F.col("_end") - 2, F.lit(0))))
    return parts.select(
        "file", "block", "row", "value",
        F.when(F.col("_begin") > 0, 1).when(ends, 0).alias("const"),
        ups(outside).alias("ups_0"), F.col("value").rlike(r"^\s*>").cast("int").alias("down_0"),
        F.coalesce(ups(inside), F.lit(0)).alias("ups_1"), F.lit(0).alias("down_1"))


def _depths(pieces: DataFrame) -> DataFrame:
    """Per row of ``_pieces`` its depth before its starts, relative to the block's entry: ``rel_0`` and ``rel_1``
    if the block begins outside or inside of a section; ``state`` is null where that still matters."""
    before = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = pieces.withColumn("state", F.last("const", ignorenulls=True).over(before))
    for z in (0, 1):
        inside = F.coalesce("state", F.lit(z)) == 1
        rows = (rows.withColumn(f"up_{z}", F.when(inside, F.col("ups_1")).otherwise(F.col("ups_0")))
                .withColumn(f"_down_{z}", F.when(inside, F.col("down_1")).otherwise(F.col("down_0"))))
    for z in (0, 1):
        net = F.sum(F.col(f"up_{z}") - F.col(f"_down_{z}")).over(before)
        rows = rows.withColumn(f"rel_{z}", F.coalesce(net, F.lit(0)) - F.col(f"_down_{z}"))
    return rows


def _entries(rows: DataFrame, row_tag: str) -> DataFrame:
    """Per block of a file what it is entered with: section state, depth and the record that is open.

    One row per block: the table grows with the files' bytes over the split
    size.  A record is opened where the depth is zero, which is the least depth of
    the block, so the last opening needs no second look at the rows.
    """
    aggs = [F.max_by("const", F.when(F.col("const").isNotNull(), F.col("row"))).alias("const")]
    for z in (0, 1):
        up = F.col(f"up_{z}") > 0
        aggs += [F.sum(F.col(f"up_{z}") - F.col(f"_down_{z}")).alias(f"net_{z}"),
                 F.min(f"rel_{z}").alias(f"low_{z}"),
                 F.min(F.when(up, F.struct(F.col(f"rel_{z}").alias("rel"), (-F.col("row")).alias("row")))).alias(f"open_{z}")]
    blocks = rows.groupBy("file", "block").agg(*aggs)
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = blocks.withColumn("inside", F.coalesce(F.last("const", ignorenulls=True).over(past), F.lit(0)))

    def pick(name: str) -> Column:
        return F.when(F.col("inside") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    blocks = blocks.select("file", "block", "inside", pick("net").alias("net"), pick("low").alias("low"),
                           pick("open").alias("open"))
    blocks = blocks.withColumn("depth", F.coalesce(F.sum("net").over(past), F.lit(0)))
    opened = F.when(F.col("open.rel") + F.col("depth") == 0, F.struct("block", (-F.col("open.row")).alias("row")))
    wrong = (F.col("depth") + F.col("low") < 0) | (F.sum("net").over(whole) != 0)
    message = F.concat(F.lit(f"starts and ends of <{row_tag}> do not match in "), F.col("file"))
    blocks = blocks.withColumn("opened", opened).withColumn("wrong", wrong)
    # The error is part of the depth that every record needs, so no column pruning removes the check.
    depth = F.when(F.col("wrong"), F.raise_error(message).cast("bigint")).otherwise(F.col("depth"))
    return blocks.select("file", "block", "inside", depth.alias("depth"),
                         F.last("opened", ignorenulls=True).over(past).alias("carried"))


def read_xml_records(spark: SparkSession, path: str | Sequence[str], row_tag: str) -> DataFrame:
    """``(file, block, row, xml)``: the outermost ``row_tag`` elements of XML files (or globs), in any layout.

    Parts are shuffled once, by the block that they start in, to learn their
    depth, and once by record to be put together; a block is at most a split, a
    record is one element, so neither groups more than that.  ``(file, block,
    row)`` is the place of the record's start and orders the records of a file.
    Starts and ends that do not match are an error.  A comment or CDATA section
    may hold the row tag; one that holds both an end of the row tag and a mark of
    the other kind of section is not told apart.
    """
    tag = re.escape(row_tag)
    rows = _depths(_pieces(spark, path, row_tag))
    rows = rows.join(_entries(rows, row_tag), ["file", "block"])
    up, rel = (F.when(F.col("inside") == 1, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0")) for c in ("up", "rel"))
    rows = rows.select("file", "block", "row", "value", "carried", (F.col("depth") + rel).alias("at"), up.alias("up"),
                       F.coalesce("state", "inside").alias("state"))
    opens = (F.col("at") == 0) & (F.col("up") > 0)
    so_far = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    here = F.last(F.when(opens, F.struct("block", "row")), ignorenulls=True).over(so_far)
    # What precedes a record's start tag: text, sections, other tags and empty elements of its own name.
    skipped = (rf"\G(?:[^<]++|<!--(?s:.*?)-->|<!\[CDATA\[(?s:.*?)\]\]>|<{tag}(?=[\s/>])[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')"
               rf"[^>\"']*)*/>|<(?!{tag}[\s/>])[^<]*+)")
    after = F.when(F.col("state") == 1, F.regexp_replace("value", rf"^(?s:.*?)(?:{_END})", "")).otherwise(F.col("value"))
    text = F.when(opens, F.regexp_replace(after, skipped, "")).otherwise(F.concat(F.lit(f"</{row_tag}"), F.col("value")))
    placed = rows.filter(opens | (F.col("at") > 0)).select(
        "file", F.coalesce(here, "carried").alias("record"), F.struct("block", "row", text.alias("text")).alias("part"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["text"]), "")
    return (placed.groupBy("file", "record").agg(F.concat(whole, F.lit(f"</{row_tag}>")).alias("xml"))
            .select("file", "record.block", "record.row", "xml"))


def read_entity_xml(spark: SparkSession, path: str | Sequence[str], row_tag: str = "drug",
                    feature_prefix: str = "TARGET_", duplicates: str = "greatest") -> DataFrame:
    """Scan of entity XML files (or globs): one row per entity of the outermost ``row_tag`` elements.

    Of records with one id, ``duplicates`` keeps the "greatest" (whatever the
    order of files) or the "last" in file order, files by path.
    """
    records = read_xml_records(spark, path, row_tag)
    order = F.struct("file", "block", "row").alias("_place")
    return parse_entity_xml(records.select("xml", order), "xml", feature_prefix, duplicates)


def parse_entity_xml(df: DataFrame, xml_col: str, feature_prefix: str = "TARGET_",
                     duplicates: str = "greatest") -> DataFrame:
    """Parse one XML record per row of ``xml_col`` into entities.

    Names come from ``from_xml`` under an explicit schema; gene names are those
    of any descendant of a target, by an XPath over the record's text.  Namespaces
    are dropped from tags first; a record that is not well-formed is an error.
    "last" duplicates need the rows' order in a column ``_place``.
    """
    # An attribute stands between a tag's start and its end: no start follows it before that end.
    plain = F.regexp_replace(F.col(xml_col), r"""\sxmlns(?::[\w.-]+)?\s*=\s*(?:"[^"]*"|'[^']*')(?=[^<]*>)""", "")
    plain = F.regexp_replace(plain, r"""\s[\w.-]+:([\w.-]+\s*=\s*(?:"[^"]*"|'[^']*'))(?=[^<]*>)""", " $1")
    place = ["_place"] if duplicates == "last" else []
    parsed = (df.select(plain.alias("_x"), *place)
              .select(F.from_xml("_x", ENTITY_XML_SCHEMA, {"ignoreNamespace": "true", "mode": "FAILFAST"}).alias("r"),
                      F.xpath("_x", F.lit("/*/targets/target//gene-name/text()")).alias("genes"), *place)
              .select("r.*", "genes", *place))
    return entities_from_records(parsed, feature_prefix, duplicates)


def _primary_id(ids: Column) -> Column:
    """The id element flagged ``primary='true'`` (null when absent; no ANSI index error)."""
    primary = F.filter(ids, lambda x: x["_primary"] == F.lit("true"))
    return F.get(primary, 0)["_VALUE"]


def entities_from_records(records: DataFrame, feature_prefix: str = "TARGET_",
                          duplicates: str = "greatest") -> DataFrame:
    """P1-P5 on parsed records.

    Of duplicate ids one row stays: the greatest record, or the last by
    ``_place``.
    """
    if duplicates not in ("greatest", "last"):
        raise ValueError(f"duplicates must be 'greatest' or 'last', not {duplicates!r}")
    targets = F.coalesce(F.col("targets.target"), F.array())
    eid = _primary_id(F.col("`drugbank-id`"))
    place = ["_place"] if duplicates == "last" else []
    rows = records.select(
        eid.alias("entity_id"),
        F.coalesce(F.nullif(F.col("name"), F.lit("")), eid).alias("entity_name"),
        feature_tokens(F.transform(targets, lambda t: t["name"]), feature_prefix).alias("features"),
        bridge_symbols(F.coalesce(F.col("genes"), F.array().cast("array<string>"))).alias("bridge"), *place,
    ).filter(F.col("entity_id").isNotNull())
    row = F.struct("entity_name", "features", "bridge")
    best = rows.groupBy("entity_id").agg(
        (F.max_by(row, "_place") if place else F.max(row)).alias("r"))
    return best.select("entity_id", "r.entity_name", "r.features", "r.bridge")
