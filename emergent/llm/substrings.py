"""Removal of every 100-byte string that also starts earlier, by blockwise sorting of suffix buckets.

Two suffixes repeat each other when their first 100 bytes are equal.  A cover
sample resolves such long ties: positions are sampled so that equal 100-byte
strings hold a sample at the same shift, as a difference cover does.  Here the
sample is chosen by content (the position of the smallest hash among the 69
32-byte strings in the 100 bytes), because it takes 3 % of all positions where a
difference cover modulo 64 takes 14 %.

1. Every text's samples are dealt by hash bucket, in arrays; a bucket tells which
   samples occur more than once.  All other suffixes are unique and leave here.
2. The remaining suffixes go, grouped by their sample, to suffix buckets: a record
   is a sample's surroundings, which hold all suffixes that it resolves.
3. One bucket is sorted at a time, in memory bounded by ``AT_ONCE`` records: the
   texts right of the samples are ranked once, those left of them (backwards)
   too, and a suffix that starts ``d`` bytes before its sample is known by its
   class among the left texts of ``d`` bytes and among the right texts of
   ``100 - d``.  Comparisons are of bytes, not of hashes.
4. Of each class the earliest start stays; the others' bytes are removed.

A sample with more than ``CROWD`` occurrences is split: every task sorts the
records that it has itself, and only the earliest of its equal strings meet
those of other tasks, dealt by a 128-bit hash of the string.  Whole copies of a text leave
before step 2: all their strings start earlier.

Defined results: a null text is empty; texts shorter than the length keep all;
a null id counts as the smallest; rows that share an id are in an arbitrary but
fixed order; matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of, text_bytes

#: Length of the sampled strings; a power of two.
GRAM = 32
#: Bytes of text that are sampled together, and most in one piece of a longer text (positions take 24 bits).
BLOCK, PIECE = 1 << 20, 1 << 23
#: Occurrences of a sample beyond which its records are split, and records that are sorted together.
CROWD, AT_ONCE = 4096, 60_000

U = np.uint64
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.int64).astype(U)
_LOW = U((1 << 24) - 1)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes that start at each position."""
    h, factor, n = _BYTES[raw], 0x9E3779B97F4A7C15, 1
    while n < GRAM:
        h = h[:-n] * U(factor) + h[n:]
        factor = factor * factor & (1 << 64) - 1
        n *= 2
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def samples(raw: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes that share a sample, over texts laid end to end.

    ``ends`` are the texts' ends in ``raw``.  Returns, per run, its first and
    last suffix, the sample's position and its hash.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, U),)
    if len(raw) < length:
        return none
    h = gram_hashes(raw)
    least = (h & ~_LOW) | np.arange(len(h), dtype=U)
    span, n = length - GRAM + 1, 1
    while 2 * n <= span:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < span:
        least = np.minimum(least[:n - span], least[span - n:])
    at = (least & _LOW).astype(np.int64)
    # A suffix counts where its text goes on for the whole length.
    whole = np.ones(len(at), dtype=bool)
    for k in range(1, length):
        gone = ends - k
        whole[gone[(gone >= 0) & (gone < len(at))]] = False
    fresh = whole.copy()
    fresh[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    first = np.flatnonzero(fresh)
    if not len(first):
        return none
    last = whole.copy()
    last[:-1] &= (at[1:] != at[:-1]) | ~whole[1:]
    return first, np.flatnonzero(last), at[first], h[at[first]]


def _pieces(rows: Iterator[tuple], length: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, list[int]]]:
    """Rows (text first) laid end to end in blocks: rows, bytes, ends, and where each text's piece starts in it.

    A text longer than ``PIECE`` comes in pieces that overlap so that every
    suffix lies whole in exactly one of them.
    """
    held, size = [], 0
    for row in rows:
        text = row[0]
        for lo in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
            part = text if len(text) <= PIECE else text[lo:lo + PIECE]
            if held and size + len(part) > BLOCK:
                yield _laid(held)
                held, size = [], 0
            held.append((row, part, lo))
            size += len(part)
    if held:
        yield _laid(held)


def _laid(held: list[tuple[tuple, bytes, int]]) -> tuple[list[tuple], np.ndarray, np.ndarray, list[int]]:
    raw = np.frombuffer(b"".join(p for _, p, _ in held), dtype=np.uint8)
    return [r for r, _, _ in held], raw, np.cumsum([len(p) for _, p, _ in held]), [lo for _, _, lo in held]


def _columns(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, schema)],
                                      names=[n for n, _ in schema])


# ---- step 1: samples that occur more than once ----------------------------------

def _repeated(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(key, at, hot)``: texts and positions of the samples with several occurrences."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("bucket", pa.int32()), ("h", pa.binary()), ("key", pa.binary()), ("at", pa.binary())]
        rows = (r for b in batches for r in rows_of(b, "text", "key"))
        for some, raw, ends, starts in _pieces(rows, length):
            first, _, at, h = samples(raw, ends, length)
            own = np.searchsorted(ends, first, side="right")
            keys = np.array([r[1] for r in some], dtype=np.int64)[own]
            place = at - np.concatenate([[0], ends])[own] + np.array(starts)[own]
            bucket = (h % U(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            h, keys, place = h[by], keys[by], place[by].astype(np.int64)
            here = np.flatnonzero(np.diff(cuts))
            parts = [(lo, hi) for lo, hi in zip(cuts[here], cuts[here + 1])]
            yield _columns(kinds, [here, [h[lo:hi].tobytes() for lo, hi in parts],
                                   [np.diff(keys[lo:hi], prepend=0).tobytes() for lo, hi in parts],
                                   [_thin(place[lo:hi]) for lo, hi in parts]])

    dealt = (arrow_map(docs.select("text", "key"), deal, "bucket int, h binary, key binary, at binary")
             .repartition("bucket").sortWithinPartitions("bucket"))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("key", pa.int64()), ("at", pa.int64()), ("hot", pa.bool_())]
        held: list[tuple[np.ndarray, ...]] = []
        now = None

        def out() -> pa.RecordBatch:
            h, key, at = (np.concatenate(x) for x in zip(*held))
            _, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
            n = n[inverse]
            return _columns(kinds, [key[n > 1], at[n > 1], n[n > 1] > CROWD])

        for b in batches:
            for bucket, h, key, at in rows_of(b, "bucket", "h", "key", "at"):
                if bucket != now and held:
                    yield out()
                    held.clear()
                now = bucket
                held.append((np.frombuffer(h, U), np.cumsum(np.frombuffer(key, np.int64)), _thick(at)))
        if held:
            yield out()

    return arrow_map(dealt, tell, "key long, at long, hot boolean")


def _thin(x: np.ndarray) -> bytes:
    """Positions in 4 bytes where they fit; the first byte tells."""
    return b"\4" + x.astype("<u4").tobytes() if not len(x) or x.max() < 1 << 32 else b"\10" + x.tobytes()


def _thick(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if raw[:1] == b"\4" else "<i8", offset=1).astype(np.int64)


# ---- step 2: the surroundings of repeated samples --------------------------------

RECORD = [("h", pa.int64()), ("left", pa.int32()), ("around", pa.binary()), ("id", pa.int64()), ("key", pa.int64()),
          ("first", pa.int64()), ("hot", pa.bool_())]
RECORD_SQL = "h long, left int, around binary, id long, key long, first long, hot boolean"


def _records(docs: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """One row per repeated sample: its surroundings and where their first suffix starts."""
    found = hits.groupBy("key").agg(F.collect_list(F.struct("at", "hot")).alias("hits"))  # a text's own samples
    joined = docs.join(found, "key").select("text", "id", "key", F.col("hits.at").alias("at"),
                                            F.col("hits.hot").alias("hot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in rows_of(b, "text", "id", "key", "at", "hot"))
        for some, raw, ends, starts in _pieces(rows, length):
            first, last, at, h = samples(raw, ends, length)
            begin = np.concatenate([[0], ends])
            own = np.searchsorted(ends, first, side="right")
            # Positions of hits in this block.
            shift = begin[:-1] - np.array(starts)
            place = np.concatenate([np.array(r[3], np.int64) + s for r, s in zip(some, shift)] or [np.zeros(0, int)])
            text = np.repeat(np.arange(len(some)), [len(r[3]) for r in some])
            hot = np.concatenate([np.array(r[4], bool) for r in some] or [np.zeros(0, bool)])
            inside = (place >= begin[text]) & (place < ends[text])
            place, hot = place[inside], hot[inside]
            by = np.argsort(place)
            place, hot = place[by], hot[by]
            to = np.searchsorted(place, at)
            keep = np.flatnonzero((to < len(place)) & (place[np.minimum(to, max(len(place) - 1, 0))] == at)) \
                if len(place) else np.zeros(0, np.int64)
            data = raw.tobytes()
            ids = np.array([r[1] for r in some], dtype=np.int64)
            keys = np.array([r[2] for r in some], dtype=np.int64)
            o = own[keep]
            yield _columns(RECORD, [
                h[keep].view(np.int64), at[keep] - first[keep],
                [data[lo:hi + length] for lo, hi in zip(first[keep].tolist(), last[keep].tolist())],
                ids[o], keys[o], first[keep] - shift[o], hot[to[keep]]])

    return arrow_map(joined, run, RECORD_SQL)


# ---- step 3: sorting suffix buckets ----------------------------------------------

def _classes(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of fixed-width byte rows, and each row's common prefix with the one before it."""
    order = np.argsort(np.ascontiguousarray(texts).view(f"V{texts.shape[1]}").ravel(), kind="stable")
    by = texts[order]
    differ = by[1:] != by[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), texts.shape[1])
    return order, np.concatenate([[0], common])


def sort_bucket(left: np.ndarray, around: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of some records, given in order of their places, that repeat an earlier one.

    Returns the records' numbers and the suffixes' offsets in them.
    """
    reach = length - GRAM
    size = np.array([len(a) for a in around])
    flat = np.frombuffer(b"".join(around), dtype=np.uint8)
    at = np.cumsum(size) - size + left
    pad = np.concatenate([np.zeros(reach, np.uint8), flat, np.zeros(length, np.uint8)])
    # Bytes beyond a record are never compared: no suffix of it reaches there.
    right = pad[(at + reach)[:, None] + np.arange(length)]
    back = pad[(at + reach)[:, None] - 1 - np.arange(reach)] if reach else np.zeros((len(at), 1), np.uint8)
    r_order, r_common = _classes(right)
    l_order, l_common = _classes(back)
    out_record, out_offset = [], []
    most = left
    fewest = left - (size - length)
    l_class, r_class = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for d in range(int(fewest.min(initial=0)), int(most.max(initial=-1)) + 1):
        here = np.flatnonzero((fewest <= d) & (d <= most))
        if len(here) < 2:
            continue
        l_class[l_order] = np.cumsum(l_common < d)
        r_class[r_order] = np.cumsum(r_common < length - d)
        both = l_class[here] * (len(at) + 1) + r_class[here]
        by = np.argsort(both, kind="stable")
        again = here[by[1:][both[by[1:]] == both[by[:-1]]]]
        out_record.append(again)
        out_offset.append(left[again] - d)
    if not out_record:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_record), np.concatenate(out_offset)


def _runs(key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of texts as runs ``(key, first, one past the last)``."""
    by = np.lexsort((start, key))
    key, start = key[by], start[by]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(key)]]) - 1 if len(first) else first
    return key[first], start[first], start[last] + 1


RUN = [("key", pa.int64()), ("first", pa.int64()), ("past", pa.int64())]
RUN_SQL = "key long, first long, past long"


def _sorted_buckets(records: DataFrame, length: int) -> DataFrame:
    """Runs of repeated suffixes among records whose samples are no crowd."""
    dealt = records.repartition("h").sortWithinPartitions("h", "id", "key", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def out(t: pa.Table) -> pa.RecordBatch:
            id_, key, first = (t.column(k).to_numpy() for k in ("id", "key", "first"))
            by = np.lexsort((first, key, id_))
            around = t.column("around").take(pa.array(by)).to_pylist()
            record, offset = sort_bucket(t.column("left").to_numpy()[by].astype(np.int64), around, length)
            return _columns(RUN, _runs(key[by][record], first[by][record] + offset))

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= AT_ONCE:  # up to the last sample that may go on
                t = pa.Table.from_batches(held)
                h = t.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))
                if cut:
                    yield out(t.slice(0, cut))
                    t = t.slice(cut)
                held, n = t.to_batches(), t.num_rows
        if n:
            yield out(pa.Table.from_batches(held))

    return arrow_map(dealt, run, RUN_SQL)


def _crowded(records: DataFrame, scratch: Scratch, length: int, buckets: int) -> DataFrame:
    """Runs of repeated suffixes among records of crowded samples, without a group in one task.

    Records stay where they are: each task sorts what it has, ``AT_ONCE`` at a
    time, and knows all but the earliest of equal strings as repeated.  The
    earliest are dealt by a 128-bit hash of the string, in arrays, so a string
    arrives once from each sorted lot, however often it occurs.
    """

    def sort_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            for lo in range(0, b.num_rows, AT_ONCE):
                held.append(b.slice(lo, AT_ONCE))
                n += held[-1].num_rows
                if n >= AT_ONCE:
                    yield from _own_first(pa.Table.from_batches(held), length, buckets)
                    held, n = [], 0
        if n:
            yield from _own_first(pa.Table.from_batches(held), length, buckets)

    lots = scratch.save(arrow_map(records, sort_own, "kind int, bucket int, x binary, id binary, key binary, "
                                                     "first binary"), "lots", partition_by=("kind",))

    def own_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, first, past in rows_of(b, "key", "first", "x"):
                yield _columns(RUN, [np.frombuffer(c, np.int64) for c in (key, first, past)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        now = None

        def out() -> pa.RecordBatch:
            x, id_, key, first = (np.concatenate(c) for c in zip(*held))
            x = x.reshape(-1, 2)
            by = np.lexsort((first, key, id_, x[:, 1], x[:, 0]))
            again = by[1:][(x[by[1:]] == x[by[:-1]]).all(axis=1)]
            return _columns(RUN, _runs(key[again], first[again]))

        for b in batches:
            for bucket, x, *places in rows_of(b, "bucket", "x", "id", "key", "first"):
                if bucket != now and held:
                    yield out()
                    held.clear()
                now = bucket
                held.append((np.frombuffer(x, "<u8"), *(np.frombuffer(c, np.int64) for c in places)))
        if held:
            yield out()

    dealt = (lots.filter("kind = 1").select("bucket", "x", "id", "key", "first")
             .repartition("bucket").sortWithinPartitions("bucket"))
    return (arrow_map(lots.filter("kind = 0").select("key", "first", "x"), own_runs, RUN_SQL)
            .unionByName(arrow_map(dealt, meet, RUN_SQL)))


def _own_first(t: pa.Table, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A lot of records: runs of strings that repeat in it (kind 0), and the earliest of each by bucket (kind 1)."""
    kinds = [("kind", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in ("x", "id", "key", "first")]
    id_, key, first, left = (t.column(k).to_numpy().astype(np.int64) for k in ("id", "key", "first", "left"))
    by = np.lexsort((first, key, id_))
    id_, key, first, left = id_[by], key[by], first[by], left[by]
    around = t.column("around").take(pa.array(by)).to_pylist()
    record, offset = sort_bucket(left, around, length)
    run_key, run_first, run_past = _runs(key[record], first[record] + offset)
    yield _columns(kinds, [[0], [0], [run_past.tobytes()], [b""], [run_key.tobytes()], [run_first.tobytes()]])
    n = np.array([len(a) - length + 1 for a in around])
    base = np.cumsum(n) - n
    fresh = np.ones(int(n.sum()), bool)
    fresh[base[record] + offset] = False
    own = np.repeat(np.arange(len(n)), n)[fresh]
    at = (np.arange(len(fresh)) - np.repeat(base, n))[fresh]
    x = np.frombuffer(b"".join(xxhash.xxh3_128_digest(around[r][k:k + length])
                               for r, k in zip(own.tolist(), at.tolist())), "<u8").reshape(-1, 2)
    bucket = (x[:, 0] % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        some = order[cuts[k]:cuts[k + 1]]
        yield _columns(kinds, [[1], [k], [x[some].tobytes()], [id_[own[some]].tobytes()], [key[own[some]].tobytes()],
                               [(first[own[some]] + at[some]).tobytes()]])


# ---- step 4 and the operator ------------------------------------------------------

def repeated_runs(docs: DataFrame, scratch: Scratch, length: int, buckets: int) -> DataFrame:
    """Saved runs ``(key, first, past)`` of suffixes that repeat an earlier one, of ``docs(key, id, text)``."""
    copies = (docs.filter(F.length("text") >= length)
              .select("id", "key", F.length("text").alias("n"), F.sha2("text", 256).alias("sha")))
    firsts = copies.groupBy("sha").agg(F.min(F.struct("id", "key")).alias("p"), F.count("*").alias("c")).filter("c > 1")
    again = scratch.save(copies.join(firsts, "sha").filter("key <> p.key").select("key", "n"), "copies")
    hits = scratch.save(_repeated(docs, length, buckets).join(again.select("key"), "key", "left_anti"), "hits")
    records = scratch.save(_records(docs, hits, length), "records")
    runs = (_sorted_buckets(records.filter("not hot"), length)
            .unionByName(_crowded(records.filter("hot"), scratch, length, buckets))
            .unionByName(again.select("key", F.lit(0).cast("long").alias("first"),
                                      (F.col("n") - length + 1).cast("long").alias("past"))))
    return scratch.save(runs, "runs")


def deduplicated(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                 buckets: int | None = None) -> DataFrame:
    """``(id_col, kept, n_bytes, n_removed, n_spans)`` per row; ``kept`` are the remaining bytes.

    ``length`` may be 33 or more.
    """
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    spark = df.sparkSession
    scratch = Scratch(spark, "substrings")
    buckets = buckets or max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = df.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("text"))
    shared = docs.groupBy("doc").agg(F.count("*").alias("c")).filter("c > 1 or doc is null").limit(1).count()
    if shared:  # ids do not tell rows apart: a written table with row numbers does
        docs = scratch.save(docs.withColumn("key", F.monotonically_increasing_id()), "rows")
    else:
        docs = docs.withColumn("key", F.col("doc"))
    docs = docs.withColumn("id", F.coalesce("doc", F.lit(-(1 << 63))))
    runs = repeated_runs(docs.select("key", "id", "text"), scratch, length, buckets)
    scratch.drop("hits", "records", "copies", "lots")
    scratch.release()
    found = runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("first", "past"))).alias("runs"))
    joined = docs.join(found, "key", "left").select("doc", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                 ("n_spans", pa.int64())]
        for b in batches:
            rows = [(doc, *_without(text, found, length)) for doc, text, found in rows_of(b, "doc", "text", "runs")]
            yield _columns(kinds, list(zip(*rows)) if rows else [[]] * 5)

    return arrow_map(joined, run, "doc long, kept binary, n_bytes long, n_removed long, n_spans long") \
        .withColumnRenamed("doc", id_col)


def _without(text: bytes, runs: list[dict] | None, length: int) -> tuple[bytes, int, int, int]:
    """What remains of a text, its size, the bytes and the spans removed."""
    spans: list[list[int]] = []
    for r in runs or []:
        lo, hi = r["first"], r["past"] - 1 + length
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(hi, spans[-1][1])
        else:
            spans.append([lo, hi])
    kept, at = [], 0
    for lo, hi in spans:
        kept.append(text[at:lo])
        at = hi
    kept.append(text[at:])
    rest = b"".join(kept)
    return rest, len(text), len(text) - len(rest), len(spans)


def digest(kept: bytes) -> str:
    """The checksum that the query reports."""
    return hashlib.sha256(kept).hexdigest()
