"""A7 on vertical bitmaps: the frequent (item set, label) pairs and their counts.

Transactions are numbered in blocks; a block keeps one bitmap per frequent item
over its transactions, the multiplicities as bit planes, and its transactions
sorted by label, each label on whole machine words.  A set's bitmap is the
conjunction of its items'; a plane's conjunction with it is counted by words, and
a label's count is the sum over the label's words.  So a level of the search
reads the blocks, which never move after they are written, and shuffles counts
only (blocks × candidates, combined per task before the shuffle).

Level k+1 extends pairs of frequent k-sets that share their first k-1 items and
a label they are both frequent with.  Labels below the threshold are counted
together: they can have no rules, but count for the antecedent.  At most
``PAIRS_A_PASS`` candidates are counted at once, in as many passes as there are.
The driver holds a level's frequent (set, label) pairs, whose number depends on
the support and not on the rows: for single items it is at most (items a
transaction) / (min support), for labels 1 / (min support).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.session import reliable

#: Transactions of a block, a multiple of the word size; fewer where many items would make a block large.
BLOCK_ROWS = 8192
#: Bits of all bitmaps of a block together.
BLOCK_BITS = 1 << 28
#: Candidate sets that are counted in one pass over the blocks.
PAIRS_A_PASS = 2_000_000
#: Counts (candidates x labels) of a pass that a task keeps as one array; of larger passes it keeps what it met.
DENSE_COUNTS = 1 << 22
#: Counts met that a task holds before it combines them.
HELD_COUNTS = 1_000_000
_WORD = 64


def item_label_counts(tx: DataFrame, label: str, features: str, weight: str) -> DataFrame:
    """Saved ``(item, label, n)``."""
    return reliable(tx.select(F.explode(features).alias("item"), F.col(label), weight)
                    .groupBy("item", label).agg(F.sum(weight).alias("n")), "item-counts")


def _block_builder(items: list[str], labels: list, rows_a_block: int):
    """``mapInArrow`` function: (label, features, weight) rows to blocks.  It refers to no module of this package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kinds = pa.array(items, pa.string()), None

        def block(label: np.ndarray, weight: np.ndarray, row: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
            order = np.argsort(label, kind="stable")
            found, first, size = np.unique(label[order], return_index=True, return_counts=True)
            words = -(-size // 64)
            starts = np.concatenate(([0], np.cumsum(words)[:-1]))
            place = np.empty(len(label), np.int64)
            # Each label begins on a word of its own.
            place[order] = np.arange(len(label)) + np.repeat(64 * starts - first, size)
            total = 64 * int(words.sum())
            present, line = np.unique(item, return_inverse=True)
            bits = np.zeros((len(present), total), bool)
            bits[line, place[row]] = True
            spread = np.zeros(total, np.int64)
            spread[place] = weight
            planes = max(1, int(spread.max(initial=0)).bit_length())
            plane = np.stack([(spread >> p & 1).astype(bool) for p in range(planes)])

            def packed(x: np.ndarray) -> bytes:
                return np.packbits(x, axis=1, bitorder="little").tobytes()

            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((present.astype("<i4").tobytes(), pa.binary()), (packed(bits), pa.binary()),
                                               (packed(plane), pa.binary()), (found.astype("<i4").tobytes(), pa.binary()),
                                               (starts.astype("<i4").tobytes(), pa.binary()))],
                names=["items", "bits", "planes", "labels", "starts"])

        for batch in batches:
            if kinds is None:
                kinds = pa.array(labels, batch.column(0).type)
            for lo in range(0, batch.num_rows, rows_a_block):
                part = batch.slice(lo, rows_a_block)
                label = pc.fill_null(pc.index_in(part.column(0), value_set=kinds), -1).to_numpy(zero_copy_only=False)
                lists = part.column(1)
                code = pc.index_in(pc.list_flatten(lists), value_set=known)
                row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
                ok = pc.is_valid(code).to_numpy(zero_copy_only=False)
                code = pc.fill_null(code, 0).to_numpy(zero_copy_only=False)
                yield block(label.astype(np.int64), part.column(2).to_numpy(zero_copy_only=False), row[ok], code[ok])

    return run


def _candidate_counter(shared, items: list[str], n_labels: int, longer: int):
    """``mapInArrow`` function: blocks to ``(antecedent, label number, n)`` of a pass's candidates of ``longer`` items.

    ``shared`` holds groups ``(prefix, last items, their labels as bits, from, to)``;
    the candidates are the prefix with a last item in that range and a later one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        names = pa.array(items, pa.string())
        # Candidates in order: runs (group, first member) with the later members that share a label with it.
        runs: list[list[tuple[int, int, np.ndarray]]] = []
        ends, prefixes, firsts, seconds = [0], [], [], []
        for prefix, last, masks, lo, hi in groups:
            runs.append([])
            for i in range(lo, hi):
                js = i + 1 + np.flatnonzero((masks[i + 1:] & masks[i]).any(axis=1))
                if len(js):
                    runs[-1].append((ends[-1], i, js))
                    prefixes.append(prefix)
                    firsts.append(last[i])
                    seconds.append(last[js])
                    ends.append(ends[-1] + len(js))
        if not firsts:
            return
        prefix_of, first_of = np.array(prefixes, np.int64).reshape(len(prefixes), longer - 2), np.array(firsts)
        second_of = np.concatenate(seconds)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        dense = np.zeros((ends[-1], n_labels + 1), np.int64) if ends[-1] * (n_labels + 1) <= DENSE_COUNTS else None

        def combined() -> tuple[np.ndarray, np.ndarray]:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        def out(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            pair, label = key // (n_labels + 1), key % (n_labels + 1) - 1
            for lo in range(0, len(key), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                run_of = np.searchsorted(ends, pair[s], side="right") - 1
                codes = np.column_stack((prefix_of[run_of], first_of[run_of], second_of[pair[s]]))
                bounds = pa.array(np.arange(0, codes.size + 1, longer), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(bounds, names.take(pa.array(codes.ravel()))),
                     pa.array(label[s], pa.int32()), pa.array(n[s], pa.int64())], names=["antecedent", "label", "n"])

        for batch in batches:
            for r in range(batch.num_rows):
                present, bits, planes, found, starts = (batch.column(c)[r].as_py() for c in range(5))
                present, found, starts = (np.frombuffer(x, "<i4") for x in (present, found, starts))
                if not len(present):
                    continue
                lines = np.frombuffer(bits, "<u8").reshape(len(present), -1)
                weights = np.frombuffer(planes, "<u8").reshape(-1, lines.shape[1])
                line = np.full(len(items), -1)
                line[present] = np.arange(len(present))
                for (prefix, last, *_), some in zip(groups, runs):
                    chosen = line[np.array(prefix, np.int64)]
                    if (chosen < 0).any():
                        continue
                    rows = line[last]
                    for begin, i, js in some:
                        there = np.flatnonzero(rows[js] >= 0)
                        if rows[i] < 0 or not len(there):
                            continue
                        mask = np.bitwise_and.reduce(lines[np.append(chosen, rows[i])], axis=0)
                        met = lines[rows[js[there]]] & mask
                        n = sum(np.add.reduceat(np.bitwise_count(met & w), starts, axis=1, dtype=np.int64) << p
                                for p, w in enumerate(weights))
                        if dense is not None:
                            dense[np.ix_(begin + there, found + 1)] += n
                            continue
                        x, y = np.nonzero(n)
                        keys.append((begin + there[x]) * (n_labels + 1) + found[y] + 1)
                        counts.append(n[x, y])
                        held += len(x)
                        if held > HELD_COUNTS:
                            key, n = combined()
                            keys, counts, held = [key], [n], len(key)
                            if held > HELD_COUNTS // 2:
                                yield from out(key, n)
                                keys, counts, held = [], [], 0
        if dense is not None:
            key = np.flatnonzero(dense)
            yield from out(key, dense.ravel()[key])
        elif held:
            yield from out(*combined())

    return run


def frequent_sets(tx: DataFrame, mc: int, max_antecedent: int | None = None, label: str = "label_id",
                  features: str = "features", weight: str = "multiplicity",
                  ones: DataFrame | None = None) -> tuple[DataFrame | None, int]:
    """``(antecedent, label, length, n)`` of every label count of the sets that reach ``mc`` with some label,
    and how many (set, label) pairs reach it.

    The rows of a set sum to its count over all transactions; those with a null
    label are the labels below ``mc`` together.  ``None`` and 0 if nothing reaches it.
    """
    spark = tx.sparkSession
    ones = item_label_counts(tx, label, features, weight) if ones is None else ones
    hits = ones.filter(F.col("n") >= mc).select("item", label).collect()
    if not hits:
        return None, 0
    items, labels = sorted({r[0] for r in hits}), sorted({r[1] for r in hits})
    code, kind = {x: i for i, x in enumerate(items)}, {x: i for i, x in enumerate(labels)}
    rows_a_block = max(_WORD, min(BLOCK_ROWS, BLOCK_BITS // len(items) // _WORD * _WORD))
    built = tx.select(F.col(label), F.col(features), F.col(weight).cast("long")).mapInArrow(
        _block_builder(items, labels, rows_a_block), "items binary, bits binary, planes binary, labels binary, starts binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = reliable(built.repartition(max(parts, spark.sparkContext.defaultParallelism)), "blocks")
    label_type = tx.schema[label].dataType
    known = spark.createDataFrame(list(enumerate(labels)), T.StructType(
        [T.StructField("_code", T.IntegerType()), T.StructField(label, label_type)]))
    listed = spark.createDataFrame([([x],) for x in items], "antecedent array<string>")
    first = (ones.join(known, label, "left").groupBy(F.array("item").alias("antecedent"), "_code").agg(F.sum("n").alias("n"))
             .join(listed, "antecedent", "left_semi"))
    levels = [first]
    sets = [((code[r[0]],), kind[r[1]]) for r in hits]
    groups = _grouped(sets, len(labels))
    n_sets, k = len(hits), 1
    while groups is not None and (max_antecedent is None or k < max_antecedent):
        k += 1
        counted = None
        for some in _passes(groups):
            shared = spark.sparkContext.broadcast(some)
            part = blocks.mapInArrow(_candidate_counter(shared, items, len(labels), k),
                                     "antecedent array<string>, label int, n long")
            counted = part if counted is None else counted.unionByName(part)
        if counted is None:
            break
        per_label = counted.groupBy("antecedent", F.col("label").alias("_code")).agg(F.sum("n").alias("n"))
        per_set = per_label.groupBy("antecedent").agg(
            F.collect_list(F.struct("_code", "n")).alias("_c"),
            F.max(F.when(F.col("_code") >= 0, F.col("n"))).alias("_most")).filter(F.col("_most") >= mc)
        level = reliable(per_set.select("antecedent", F.explode("_c").alias("_c")).select("antecedent", "_c.*"), f"sets-{k}")
        levels.append(level)
        hits = level.filter((F.col("n") >= mc) & (F.col("_code") >= 0)).select("antecedent", "_code").collect()
        n_sets += len(hits)
        groups = _grouped((([code[x] for x in r[0]], r[1]) for r in hits), len(labels))
    out = levels[0].withColumn("length", F.lit(1))
    for i, level in enumerate(levels[1:]):
        out = out.unionByName(level.withColumn("length", F.lit(i + 2)))
    return out.join(known, "_code", "left").select("antecedent", label, "length", "n"), n_sets


def _grouped(sets, n_labels: int) -> list | None:
    """Frequent sets ``(codes, label number)`` by their prefix: ``(prefix, last items, label bits)``; None if there are none."""
    found: dict[tuple, dict[int, np.ndarray]] = {}
    for codes, kind in sets:
        mask = found.setdefault(tuple(codes[:-1]), {}).setdefault(codes[-1], np.zeros(-(-n_labels // 8), np.uint8))
        mask[kind >> 3] |= np.uint8(1 << (kind & 7))
    if not found:
        return None
    return [(prefix, np.array(sorted(ends)), np.stack([ends[x] for x in sorted(ends)]))
            for prefix, ends in sorted(found.items())]


def _passes(groups: list) -> Iterator[list]:
    """Groups with ranges of first members, at most about ``PAIRS_A_PASS`` candidates in a pass."""
    held, size = [], 0
    for prefix, last, masks in groups:
        lo = 0
        while lo < len(last) - 1:
            hi, more = lo, 0
            while hi < len(last) - 1 and (hi == lo or size + more + len(last) - 1 - hi <= PAIRS_A_PASS):
                more += len(last) - 1 - hi
                hi += 1
            held.append((prefix, last, masks, lo, hi))
            size, lo = size + more, hi
            if size >= PAIRS_A_PASS or lo < len(last) - 1:
                yield held
                held, size = [], 0
    if held:
        yield held
