"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector, less the mean of all, is divided by its length, rotated by one
random orthogonal matrix, and kept as the signs of its coordinates (one bit
each) with two correction scalars: the length and the inner product ``f`` of the
unit vector with its code.  For a query the code's inner product divided by
``f`` is an unbiased estimate, off by at most
``EPSILON * sqrt((1 - f^2) / (f^2 (d - 1)))`` times both lengths with high
probability.  The best estimates are scored exactly; every vector whose upper
bound reaches the k-th exact score so far is scored exactly too.

Queries and candidates meet in blocks: a task takes one block of codes and one
block of queries and returns each query's best.  Equal vectors are one candidate
with their smallest ids, and equal queries are searched once, so copies make
no work.

Defined results: vectors that are null, zero, hold null or non-finite
components, have no id, or another length than most vectors take no part;
repeated rows count once; ties go to the smaller id; fewer candidates than asked
for are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of

#: Confidence of the error bound, in standard deviations of the estimate.
EPSILON = 2.5
#: Best estimates of a block that are scored exactly first, to know what the rest must reach.
FIRST = 256
#: Vectors of a block of codes, and queries of a block.
CODES, QUERIES = 16_384, 1024


def rotation(d: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths and inner products with the code of some vectors."""
    rest = vectors.astype(np.float64) - center
    length = np.linalg.norm(rest, axis=1)
    unit = rest @ turn / np.maximum(length, 1e-300)[:, None]
    bits = unit > 0
    fit = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), length.astype(np.float32), np.maximum(fit, 1e-3).astype(np.float32)


def search(queries: np.ndarray, vectors: np.ndarray, codes: np.ndarray, length: np.ndarray, fit: np.ndarray,
           center: np.ndarray, turn: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the positions and exact scores of its best ``k`` vectors of a block, in no order."""
    d = vectors.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(d))
    turned = (queries @ turn).astype(np.float32)
    base = queries @ center
    size = np.linalg.norm(queries, axis=1)
    spread = (EPSILON * np.sqrt(np.maximum(0, 1 - fit * fit) / max(1, d - 1)) / fit * length).astype(np.float32)
    scale = length / fit
    exact = vectors.astype(np.float64)
    for lo in range(0, len(queries), 128):
        estimate = turned[lo:lo + 128] @ signs.T * scale
        for i, row in enumerate(estimate, lo):
            if len(row) <= max(FIRST, k):
                at = np.arange(len(row))
            else:
                m = max(FIRST, k)
                first = np.argpartition(row, len(row) - m)[len(row) - m:]
                worst = np.partition((exact[first] * queries[i]).sum(axis=1), m - k)[m - k]
                # A hair of slack for the single-precision estimate.
                slack = 1e-5 * (1 + abs(worst))
                at = np.flatnonzero(row + spread * np.float32(size[i]) + np.float32(base[i]) >= worst - slack)
                at = np.union1d(at, first)
            yield at, (exact[at] * queries[i]).sum(axis=1)


def _usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            is_query: Column | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest of every query row among all other ids."""
    scratch = Scratch(df.sparkSession, "ann")
    asked = is_query if is_query is not None else F.lit(True)
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"),
                      asked.alias("asked")).filter(F.col("id").isNotNull()).filter(_usable(F.col("v"))))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    rows = rows.filter(F.size("v") == d)

    # One row per distinct vector, with its k + 1 smallest ids (limited per task before the shuffle).
    order = Window.partitionBy("v").orderBy("id")
    few = rows.select("v", "id").withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1)
    vectors = few.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    vectors = scratch.save(vectors.withColumn("g", F.monotonically_increasing_id()), "vectors")
    asking = scratch.save(rows.filter("asked").select(F.col("id").alias("query_id"), "v").distinct()
                          .join(vectors.select("v", "g"), "v").select("query_id", "g"), "asking")
    searched = vectors.join(asking.select("g").distinct(), "g").select("g", "v")

    center, turn = _mean(vectors, d), rotation(d)
    blocks = scratch.save(_code_blocks(vectors, d, center, turn), "codes")
    # A number per block of vectors; the blocks themselves go straight to their queries.
    numbers = F.split(F.lit(",".join(str(r["block"]) for r in blocks.select("block").collect()) or None), ",")
    pairs = _query_blocks(searched, d).withColumn("block", F.explode(numbers.cast("array<long>")))
    best = scratch.save(_searched(pairs.join(blocks, "block"), d, center, turn, k + 1), "best")

    by = Window.partitionBy("g").orderBy(F.desc("score"), "least")
    top = (best.withColumn("least", F.col("ids")[0]).withColumn("n", F.row_number().over(by))
           .filter(F.col("n") <= k + 1).select("g", "score", F.explode("ids").alias("id")))
    by = Window.partitionBy("g").orderBy(F.desc("score"), "id")
    top = (top.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= k + 1)
           .groupBy("g").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("top")))
    others = F.slice(F.filter("top", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (asking.join(top, "g").select("query_id", F.posexplode(others).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_col), F.col("x.score")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """A list column of floats as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, d)


def _mean(vectors: DataFrame, d: int) -> np.ndarray:
    """Mean of the distinct vectors: a sum per task, then one of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d), 0
        for b in batches:
            total += _matrix(b.column(0), d).astype(np.float64).sum(axis=0)
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total),
                                          pa.array([n] * d, pa.int64())], names=["i", "x", "n"])

    got = (arrow_map(vectors.select("v"), run, "i int, x double, n long").groupBy("i")
           .agg((F.sum("x") / F.sum("n")).alias("m")).orderBy("i").collect())
    return np.array([r["m"] or 0.0 for r in got]) if got else np.zeros(d)


def _code_blocks(vectors: DataFrame, d: int, center: np.ndarray, turn: np.ndarray) -> DataFrame:
    """Rows of at most ``CODES`` vectors: their number, codes, scalars, the vectors for reranking and their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, b in enumerate(_regrouped(batches, CODES), TaskContext.get().partitionId() << 32):
            v = _matrix(b.column(0), d)
            codes, length, fit = encode(v, center, turn)
            ids = b.column(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([codes.tobytes()]),
                 pa.array([length.tobytes()]), pa.array([fit.tobytes()]), pa.array([v.tobytes()]),
                 pa.ListArray.from_arrays([0, len(ids)], ids)],
                names=["block", "codes", "length", "fit", "vectors", "ids"])

    return arrow_map(vectors.select("v", "ids"), run,
                     "block long, codes binary, length binary, fit binary, vectors binary, ids array<array<long>>")


def _regrouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A task's rows in batches of ``most``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        while b.num_rows:
            part = b.slice(0, most - n)
            held.append(part)
            n += part.num_rows
            b = b.slice(part.num_rows)
            if n == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _query_blocks(searched: DataFrame, d: int) -> DataFrame:
    """Rows of at most ``QUERIES`` query vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _regrouped(batches, QUERIES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(0).to_numpy().tobytes()]), pa.array([_matrix(b.column(1), d).tobytes()])],
                names=["gs", "queries"])

    return arrow_map(searched.select("g", "v"), run, "gs binary, queries binary")


def _searched(pairs: DataFrame, d: int, center: np.ndarray, turn: np.ndarray, k: int) -> DataFrame:
    """Per pair of blocks and query its best ``k`` distinct vectors: ``(g, score, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                b = batch.slice(at, 1)
                raw = dict(zip(b.schema.names, b.columns))
                get = lambda name, kind, raw=raw: np.frombuffer(raw[name][0].as_buffer(), kind)
                v = get("vectors", np.float32).reshape(-1, d)
                q = get("queries", np.float32).reshape(-1, d).astype(np.float64)
                ids = raw["ids"].flatten()
                least = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
                codes = get("codes", np.uint8).reshape(len(v), -1)
                gs, out = get("gs", np.int64), []
                for g, (where, score) in zip(gs, search(q, v, codes, get("length", np.float32),
                                                        get("fit", np.float32), center, turn, k)):
                    top = np.lexsort((least[where], -score))[:k]
                    out.append((np.full(len(top), g), score[top], where[top]))
                if out:
                    where = np.concatenate([x[2] for x in out])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([x[0] for x in out])), pa.array(np.concatenate([x[1] for x in out])),
                         ids.take(pa.array(where))], names=["g", "score", "ids"])

    cols = ["gs", "queries", "codes", "length", "fit", "vectors", "ids"]
    return arrow_map(pairs.select(*cols), run, "g long, score double, ids array<long>")
