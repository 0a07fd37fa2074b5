"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A text's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of
its word shingles.  Two fingerprints at distance <= d differ in at most d of m
bit blocks, so they agree in some choice of m - d blocks: the values of those
choices are the join keys.  Keys of a few members are verified at once; members
of crowded keys go on to narrower blocks, where the number of different
fingerprints under a key is bounded by the bits left open.  Equal fingerprints
meet once, in their representative, so copies never make pairs.

Defined results: a null or empty text (no words) has fingerprint zero and links
like any other; fewer words than the shingle make one shingle; repeated rows
share everything; a null id keeps its row and is ignored in minima.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of, text_bytes, words
from emergent.llm.graph import connected_components

#: Keys with at most this many fingerprints are verified as they are; others are split further.
CROWD = 256
#: Bit blocks of the second, narrow level.
FINE_BLOCKS = 16

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a UTF-8 text as an unsigned integer."""
    w = words(text)
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    h = np.fromiter(map(_hash, grams), dtype="<u8", count=n)
    ones = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 key: str | None = None) -> DataFrame:
    """``(id, fp)`` per row, and ``key`` if there is one; ``fp`` is the fingerprint's 64 bits as a signed long."""
    more = [F.col(key).cast("long").alias("key")] if key else []
    src = df.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t, in rows_of(b, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]],
                                             names=["id", "fp", *b.schema.names[2:]])

    return arrow_map(src, run, "id long, fp long, key long" if key else "id long, fp long")


def _masks(blocks: int, distance: int) -> list[int]:
    """Signed 64-bit masks, each keeping all but ``distance`` of the blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    part = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    full = (1 << 64) - 1
    out = [full & ~sum(part[i] for i in gone) for gone in combinations(range(blocks), distance)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    """One row per fingerprint and choice of blocks: ``(choice, part, fp)``."""
    keys = F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks)))
    return fps.select("fp", keys.alias("choice", "part"))


def _links(groups: DataFrame, distance: int) -> DataFrame:
    """Per group of fingerprints the pairs within ``distance``, as a spanning forest ``(u, v)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us: list[np.ndarray] = []
            vs: list[np.ndarray] = []
            for fps, in rows_of(b, "fps"):
                x = np.sort(np.array(fps, dtype=np.int64))
                near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= distance
                label = np.arange(len(x))
                while True:  # smallest label among the near ones, until it settles
                    low = np.where(near, label[None, :], len(x)).min(axis=1)
                    if (low == label).all():
                        break
                    label = low
                far = label != np.arange(len(x))
                us.append(x[far])
                vs.append(x[label[far]])
            u = np.concatenate(us) if us else np.zeros(0, np.int64)
            v = np.concatenate(vs) if vs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return arrow_map(groups.select("fps"), run, "u long, v long")


def near_links(fps: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """Links ``(u, v)`` that connect all pairs of distinct fingerprints ``fps(fp)`` within ``distance`` bits."""
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3")
    if distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    coarse = _keyed(fps, _masks(distance + 2, distance))
    shared = coarse.groupBy("choice", "part").agg(F.count("*").alias("n")).filter("n > 1")
    members = scratch.save(coarse.join(shared, ["choice", "part"]), "members")
    small = members.filter(F.col("n") <= CROWD).groupBy("choice", "part").agg(F.collect_list("fp").alias("fps"))
    crowded = members.filter(F.col("n") > CROWD).select("fp").distinct()
    fine = (_keyed(crowded, _masks(FINE_BLOCKS, distance)).groupBy("choice", "part")
            .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))
    return _links(small, distance).unionByName(_links(fine, distance))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                    distance: int = 2) -> DataFrame:
    """Per row ``(id_col, fingerprint, component_id)``: 16 hex digits, smallest id reachable by links."""
    scratch = Scratch(df.sparkSession, "simhash")
    docs = scratch.save(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    classes = _classes(docs, distance, scratch)
    return docs.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _classes(docs: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """Saved ``(fp, root, component_id)`` per fingerprint of ``docs(id, fp)``; a root is one component's."""
    reps = docs.groupBy("fp").agg(F.min("id").alias("rep"))
    reps = scratch.save(reps, "representatives")
    parts = connected_components(near_links(reps.select("fp"), distance, scratch), scratch)
    rooted = (reps.join(parts, reps["fp"] == parts["node"], "left")
              .select("fp", "rep", F.coalesce("component", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return scratch.save(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                distance: int = 2) -> DataFrame:
    """One row of each component, columns unchanged: that with the smallest id, nulls last, whatever ids repeat."""
    scratch = Scratch(df.sparkSession, "simhash")
    # A row number written with the rows tells them apart; ids need not.
    key = "_key"
    while key in df.columns:
        key += "_"
    rows = scratch.save(df.withColumn(key, F.monotonically_increasing_id()), "rows")
    docs = scratch.save(fingerprints(rows, id_col, text_col, shingle, key), "fingerprints")
    classes = _classes(docs.select("id", "fp"), distance, scratch).select("fp", "root")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    firsts = docs.groupBy("fp").agg(F.min(place).alias("p"))
    firsts = firsts.join(classes, "fp").groupBy("root").agg(F.min("p").alias("p")).select(F.col("p.key").alias(key))
    return rows.join(firsts, key, "left_semi").select(*df.columns)
