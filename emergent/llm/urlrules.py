"""URL filters: host-suffix and path-prefix expressions met with rules on short hash prefixes.

A rule ``(host, path, verdict)`` fits its host and all subdomains, where the
url's path starts with its own.  Every url is expanded into the expressions
``host suffix + path prefix`` that a rule could be: one per shape (number of
host labels, length of path) that the rules have.  Expressions and rules meet in
an equi-join on the first 32 bits of their SHA-256; the full digest then
confirms, and of the confirmed rules the longest wins, then that with the
longest host, then a block.  What no rule confirms gets the default.

Defined results: a null url, or one without ``://``, has an empty host and path
and meets the rules as such; repeated rows are judged each; hosts and paths of
any length cost one expression per shape, however many labels they have; a
port or user name is part of the host; a rule's null host or path is empty, a
rule without a verdict of allow or block is an error, repeated rules are one;
an empty table of rules gives every url the default, an empty table of urls an
empty result; other columns of the urls may have any names and are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scheme, host, path: the host ends at a slash, a question mark or a hash sign, the path at the latter two.
_URL = "://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str | Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _labels(host: str | Column) -> Column:
    """Number of dot-separated labels."""
    host = F.col(host) if isinstance(host, str) else host
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash and a path is empty or starts with one, so the joined text is unambiguous.
    return F.sha2(F.concat(host, path), 256)


def _prefix(digest: str) -> Column:
    """The first 32 bits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def compiled(rules: DataFrame) -> DataFrame:
    """``(prefix, digest, rule, labels, path_len, verdict)``, one row per host and path; a block goes before an allow."""
    host, path = (F.coalesce(F.col(c), F.lit("")) for c in ("host", "path"))
    known = F.col("verdict").isin("allow", "block")
    verdict = F.when(known, F.col("verdict")).otherwise(F.raise_error(F.lit("a rule's verdict is allow or block")))
    one = (rules.select(F.translate(host, _UPPER, _LOWER).alias("host"), path.alias("path"),
                        verdict.alias("verdict"))
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    return (one.select(_digest(F.col("host"), F.col("path")).alias("digest"), F.concat("host", "path").alias("rule"),
                       _labels("host").alias("labels"), F.length("path").alias("path_len"), "verdict")
            .select(_prefix("digest").alias("prefix"), "*"))


def _expressions(shapes: list[tuple[int, int]]) -> Column:
    """Per url the array of its expressions' digests, one per shape that it is long enough for."""
    found = [F.when((F.col("n_labels") >= k) & (F.length("path") >= size),
                    _digest(F.substring_index("host", ".", -k), F.substring("path", 1, size)))
             for k, size in shapes]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judged(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", *,
           default: str = "allow") -> DataFrame:
    """Per row ``(id_col, host, path, rule, verdict)``.

    Rows are numbered where they are read, so ``urls`` should be a stored table.
    The shapes are collected: there are at most as many as pairs of a label
    count and a path length among the rules, however many rules or urls there
    are.  The rules' side of the join is broadcast only by Catalyst's own size
    check; beyond it both sides are shuffled by the hash prefix and a hot
    expression is split by AQE.  Matches are reduced map side to one per url.
    """
    if default not in ("allow", "block"):
        raise ValueError("default must be allow or block")
    table = compiled(rules)
    shapes = sorted((r["labels"], r["path_len"]) for r in table.select("labels", "path_len").distinct().collect())
    rows = (urls.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        host_of(url_col).alias("host"), path_of(url_col).alias("path"))
            .withColumn("n_labels", _labels("host")))
    asked = (rows.select("row", "id", "host", "path", F.explode_outer(_expressions(shapes)).alias("asked"))
             .select("*", _prefix("asked").alias("asked_prefix")))
    # Equal prefixes meet; equal digests count.
    met = asked.join(table, F.col("asked_prefix") == F.col("prefix"), "left")
    sure = F.col("asked") == F.col("digest")
    place = F.when(sure, F.struct(F.length("rule").alias("size"), "labels", F.col("verdict").alias("verdict"), "rule"))
    best = met.groupBy("row", "id", "host", "path").agg(F.max(place).alias("best"))
    return best.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
