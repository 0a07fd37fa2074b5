"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Training counts n-grams of all orders exactly: tasks count blocks of their
texts and deal increasing 64-bit n-gram hashes, coded by their differences, by
hash bucket, so a frequent n-gram arrives once per block.  There is a bucket for
every ``BUCKET_BYTES`` of text.  A bucket quantises its counts to levels
``1 + floor(log_b c)`` and puts (n-gram, 1) ... (n-gram, level) into its own
segment of the filter.  Every n-gram is in its segment, so the filter grows with
the corpus; it stays in the written table, by bucket, and is neither collected
nor broadcast.

A probe asks for level 1, 2, ... until one is missing; the number of hits gives
the count's estimate, for all orders.  Texts are scored in blocks, each written
once as one compressed row: a block's distinct n-grams are dealt by bucket to the
segments, the levels come back to the block, and its texts are scored with them.  Probabilities interpolate:
``p(w | h) = (c(hw) + mu p(w | h')) / (c(h) + mu)``, down to an add-one unigram.

The base score uses exact counts of single tokens.  Those of the most frequent
tokens, at most ``exact_tokens`` of them, are broadcast; occurrences of other
tokens are joined with the rest of the counts.  Tokens are told apart by 64-bit
hashes.

Defined results: a null or empty text has one token, the end; without any
training text N and V are 0; rows with a null id are training rows; repeated
rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of, text_bytes, words

#: Tokens of a block whose n-grams are counted or scored together.
BLOCK = 2_000_000
#: Bytes of text that are split into words at a time, and words a worker remembers.
AT_ONCE, REMEMBERED = 2 << 20, 400_000
#: Bytes of text, and texts, that are scored together.
SCORED_BYTES, SCORED_TEXTS = 4 << 20, 50_000
#: Parts of the blocks that are scored one after the other, so that only one part's n-grams are on disk.
PARTS = 4
#: Bytes of training text for each bucket; a worker holds the n-grams of one bucket.
BUCKET_BYTES = 16 << 20
#: Blanks cannot occur in words, so these two hashes are those of no word.
START, END = xxhash.xxh64_intdigest(b" start"), xxhash.xxh64_intdigest(b" end")
#: Quantisation base, bits of the filter for each item, bits that an item sets (all in one 64-bit word).
BASE, BITS_AN_ITEM, BITS_SET = 1.5, 16, 4

_hash = partial(xxhash.xxh64_intdigest, seed=42)
U = np.uint64


class Hashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = _hash(word)
        return h


_HASHES = Hashes()


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' tokens in a row, each text as start, words, end; and where each text begins."""
    parts = [words(t) for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(p) + 2 for p in parts])])
    out = np.empty(begin[-1], dtype=U)
    get = _HASHES.__getitem__
    for p, at in zip(parts, begin):
        out[at] = START
        out[at + 1:at + 1 + len(p)] = np.fromiter(map(get, p), dtype=U, count=len(p))
        out[at + 1 + len(p)] = END
    return out, begin


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all 64 bits."""
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def grams(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """Per order 1, 2, ... the hash of the n-gram that ends at each position.

    The last ``order - 1`` tokens before a position may belong to another text;
    the caller drops those by the distance from the text's start.
    """
    out = [mix(tokens + U(1))]
    for n in range(2, order + 1):
        h = np.zeros(len(tokens), dtype=U)
        h[n - 1:] = mix(out[-1][:-1][n - 2:] * U(0x9E3779B97F4A7C15) + tokens[n - 1:] + U(n))
        out.append(h)
    return out


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a hash, by its upper half."""
    return ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def coded(h: np.ndarray) -> bytes:
    """Increasing hashes: their low bytes as they are, the steps of what is above in bytes, of which 255 goes on."""
    if not len(h):
        return b""
    rel = (h - h[0]).astype("<u8")
    low = next(k for k in range(8) if int(rel[-1]) >> 8 * k <= 128 * len(h))
    step = np.diff(rel >> U(8 * low), prepend=U(0))
    more = (step // U(255)).astype(np.int64)
    steps = np.full(len(h) + int(more.sum()), 255, np.uint8)
    steps[np.arange(len(h)) + np.cumsum(more)] = step % U(255)
    head = np.array([low, len(h), h[0]], "<u8").tobytes()
    return head + rel.view(np.uint8).reshape(-1, 8)[:, :low].tobytes() + steps.tobytes()


def decoded(raw: bytes) -> np.ndarray:
    """What ``coded`` wrote."""
    if not raw:
        return np.zeros(0, U)
    low, n, first = (int(x) for x in np.frombuffer(raw, "<u8", 3))
    rel = np.zeros((n, 8), np.uint8)
    rel[:, :low] = np.frombuffer(raw, np.uint8, n * low, 24).reshape(n, low)
    steps = np.frombuffer(raw, np.uint8, offset=24 + n * low)
    return rel.view("<u8")[:, 0] + (np.cumsum(steps, dtype=U)[steps != 255] << U(8 * low)) + U(first)


def level_of(counts: np.ndarray) -> np.ndarray:
    """The quantised count, 1 for a single occurrence."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def estimates() -> np.ndarray:
    """The mean count of each level (0 at level 0)."""
    out = [0.0]
    for q in range(1, 110):
        lo, hi = int(np.ceil(BASE ** (q - 1) - 1e-9)), int(np.ceil(BASE ** q - 1e-9)) - 1
        out.append((lo + max(lo, hi)) / 2)
    return np.array(out)


def _place(h: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the segment and bits in it of the item (n-gram, level)."""
    x = mix(h + np.asarray(level).astype(U) * U(0x9E3779B97F4A7C15))
    word = ((x >> U(32)) * np.asarray(size).astype(U) >> U(32)).astype(np.int64)
    bits = np.zeros(len(x), dtype=U)
    for k in range(BITS_SET):
        bits |= U(1) << (x >> U(6 * k) & U(63))
    return word, bits


def build_segment(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bucket's part of the filter, as large as its n-grams need."""
    level = level_of(counts)
    size = max(1, -(-int(level.sum()) * BITS_AN_ITEM // 64))
    segment = np.zeros(size, dtype=U)
    for q in range(1, int(level.max(initial=0)) + 1):
        np.bitwise_or.at(segment, *_place(h[level >= q], q, size))
    return segment


class Filter:
    """The assembled log-frequency Bloom filter."""

    def __init__(self, sizes: np.ndarray, segments: Iterable[tuple[int, bytes | np.ndarray]]):
        """``sizes`` are the words of each bucket's segment (at least one); absent segments are empty."""
        self.size = np.maximum(sizes, 1).astype(np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.words = np.zeros(int(self.size.sum()), U)
        for bucket, segment in segments:
            part = np.frombuffer(segment, U)
            self.words[self.at[bucket]:self.at[bucket] + len(part)] = part
        self.estimate = estimates()

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Estimated counts by repeated probes."""
        return self.estimate[self.levels(h)]

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Levels by repeated probes, 0 where there is none."""
        level = np.zeros(len(h), dtype=np.int64)
        bucket = bucket_of(h, len(self.size))
        at, size, live, q = self.at[bucket], self.size[bucket], np.arange(len(h)), 1
        while len(live):
            word, bits = _place(h[live], q, size[live])
            hit = self.words[at[live] + word] & bits == bits
            live = live[hit]
            level[live] = q
            q += 1
            if q >= len(self.estimate):
                break
        return level


def _blocks(batches: Iterator[pa.RecordBatch], *cols: str) -> Iterator[list[tuple]]:
    """Rows in lists of at most ``AT_ONCE`` bytes of text (the first column), or a single row."""
    block, size = [], 0
    for b in batches:
        for row in rows_of(b, *cols):
            if block and size + len(row[0]) > AT_ONCE:
                yield block
                block, size = [], 0
            block.append(row)
            size += len(row[0])
    if block:
        yield block


def _counted(tokens: np.ndarray, begin: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order the distinct n-gram hashes, increasing, and their counts; a text's start is a token of order 1."""
    inside = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))
    return [np.unique(h[inside >= n - 1], return_counts=True) for n, h in enumerate(grams(tokens, order), 1)]


def count_ngrams(texts: DataFrame, scratch: Scratch, *, order: int, buckets: int) -> DataFrame:
    """Count all n-grams of ``texts(text binary)`` and build the filter's segments.

    One saved row per bucket: segment, and the bucket's tokens with exact
    counts (hashes of order 1, counts, number by power of two), starts left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate([t for t, _ in held])
            shift = np.cumsum([0, *(len(t) for t, _ in held)])
            begin = np.concatenate([b[:-1] + s for (_, b), s in zip(held, shift)] + [shift[-1:]])
            for n, (h, c) in enumerate(_counted(tokens, begin, order), 1):
                some, at = _dealt(h, buckets)
                c = c.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), n, np.int32)),
                     pa.array([coded(h[lo:hi]) for lo, hi in zip(at, at[1:])], pa.binary()),
                     pa.array([_small_counts(c[lo:hi]) for lo, hi in zip(at, at[1:])], pa.binary())],
                    names=["bucket", "n", "h", "c"])

        for block in _blocks(batches, "text"):
            held.append(token_hashes([t for t, in block]))
            n += len(held[-1][0])
            if n >= BLOCK:
                yield from out()
                held.clear()
                n = 0
        if held:
            yield from out()

    dealt = (arrow_map(texts.select("text"), count, "bucket int, n int, h binary, c binary")
             .repartition("bucket").sortWithinPartitions("bucket", "n"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        now = None

        def out() -> pa.RecordBatch:
            def total(orders: range) -> tuple[np.ndarray, np.ndarray]:
                some = [(decoded(h), _wide_counts(c)) for n, h, c in held if n in orders]
                if not some:
                    return np.zeros(0, U), np.zeros(0, np.int64)
                h = np.concatenate([x for x, _ in some])
                by = np.argsort(h, kind="stable")  # merges what is in order already
                h = h[by]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                return h[first], np.add.reduceat(np.concatenate([x for _, x in some])[by], first)

            more, c_more = total(range(2, order + 1))
            h, c = total(range(1, 2))
            segment = build_segment(np.concatenate([h, more]), np.concatenate([c, c_more]))
            word = h != mix(np.array([START], U) + U(1))
            h, c = h[word], c[word]
            by = np.bincount(np.floor(np.log2(c)).astype(np.int64), minlength=48)[:48] if len(c) else np.zeros(48, int)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([segment.tobytes()]),
                 pa.array([h.tobytes()]), pa.array([c.tobytes()]), pa.array([int(c.sum())], pa.int64()),
                 pa.array([by.tolist()], pa.list_(pa.int64()))],
                names=["bucket", "segment", "h", "c", "tokens", "by_power"])

        for b in batches:
            for bucket, n, h, c in rows_of(b, "bucket", "n", "h", "c"):
                if bucket != now and held:
                    yield out()
                    held.clear()
                now = bucket
                held.append((n, h, c))
        if held:
            yield out()

    return scratch.save(arrow_map(dealt, build, "bucket int, segment binary, h binary, c binary, "
                                                "tokens long, by_power array<long>"), "buckets", tidy=True)


def _small_counts(c: np.ndarray) -> bytes:
    """Counts as bytes where all are below 256, else as 4-byte integers; the first byte tells."""
    return b"\1" + c.astype(np.uint8).tobytes() if not len(c) or c.max() < 256 else b"\4" + c.astype("<u4").tobytes()


def _wide_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if raw[:1] == b"\1" else "<u4", offset=1).astype(np.int64)


def _asked(tokens: np.ndarray, begin: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of all orders, and where those of the occurrences are among them, order by order."""
    inside = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))
    return np.unique(np.concatenate([h[inside >= n - 1] for n, h in enumerate(grams(tokens, order), 1)]),
                     return_inverse=True)


def _dealt(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that have any of the increasing hashes, and where each one's begin (and the last ends)."""
    some, at = np.unique(bucket_of(h, buckets), return_index=True)  # buckets are runs of hashes
    return some, np.append(at, len(h))


class Model:
    """What scoring broadcasts: the exact counts of the most frequent tokens and a few numbers."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, order: int, mu: float,
                 threshold: int, buckets: int):
        #: Increasing hashes of order 1 and their counts.
        self.keys, self.counts, self.buckets = keys, counts, buckets
        self.tokens, self.distinct, self.order, self.mu, self.threshold = tokens, distinct, order, mu, threshold
        self.estimate = estimates()

    def score(self, texts: list[bytes], answers: list[bytes]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known ones and sum of log10(c + 1) among the frequent, model score; and the rest's hashes.

        ``answers`` are the levels of the texts' distinct n-grams, bucket by bucket.
        """
        t, begin = token_hashes(texts)
        inside = np.arange(len(t)) - np.repeat(begin[:-1], np.diff(begin))
        own = inside > 0
        add = lambda x: np.add.reduceat(x, begin[:-1])
        n_tokens = add(own.astype(np.int64))
        distinct, inverse = np.unique(t, return_inverse=True)
        distinct = mix(distinct + U(1))
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        found = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        exact = np.where(found, self.counts[at], 0) if len(self.keys) else np.zeros(len(distinct))
        n_known = add((own & (exact > 0)[inverse]).astype(np.int64))
        logs = add(np.where(own, np.log10(exact + 1)[inverse], 0.0))
        rest = own & ~found[inverse] if self.threshold > 1 else np.zeros(len(t), bool)

        h, where = _asked(t, begin, self.order)
        estimated = self.estimate[np.frombuffer(b"".join(answers), np.uint8)]
        history, p, done = None, None, 0
        for n in range(1, self.order + 1):
            have = inside >= n - 1
            c = np.zeros(len(t))
            here = int(have.sum())
            c[have] = estimated[where[done:done + here]]
            done += here
            if n == 1:
                p = (c + 1) / (self.tokens + self.distinct + 1)
            else:
                before = np.zeros(len(t))
                before[1:] = history[:-1]
                p = np.where(have, (np.minimum(c, before) + self.mu * p) / (before + self.mu), p)
            history = c
        score = add(np.where(own, np.log10(p), 0.0))
        split = np.split(mix(t[rest] + U(1)), np.cumsum(add(rest.astype(np.int64)))[:-1])
        return n_tokens, n_known, logs, score, split


def train(texts: DataFrame, scratch: Scratch, *, order: int = 2, mu: float = 4.0, buckets: int | None = None,
          exact_tokens: int = 1_500_000) -> tuple[Model, DataFrame]:
    """Count and build the model from ``texts(text binary)``; also returns the saved bucket table, with the filter.

    What reaches the driver is bounded: the exact counts by 16 bytes times
    ``exact_tokens``, and a few numbers.
    """
    spark = texts.sparkSession
    if not buckets:
        size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    table = count_ngrams(texts, scratch, order=order, buckets=buckets)
    powers = [r["n"] for r in table.select(F.posexplode("by_power").alias("power", "n")).groupBy("power")
              .agg(F.sum("n").alias("n")).orderBy("power").collect()]
    tokens = table.agg(F.sum("tokens")).first()[0] or 0
    distinct = sum(powers)
    # Token counts of at least this power of two are broadcast: the most that fit.
    power = next((k for k in range(len(powers)) if sum(powers[k:]) <= exact_tokens), len(powers))
    threshold = 1 << power

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(np.frombuffer(h, U), np.frombuffer(c, np.int64)) for h, c in rows_of(b, "h", "c")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[c >= threshold].tobytes() for h, c in rows], pa.binary()),
                 pa.array([c[c >= threshold].tobytes() for h, c in rows], pa.binary())], names=["h", "c"])

    got = arrow_map(table.select("h", "c"), frequent, "h binary, c binary").collect()
    keys = np.concatenate([np.frombuffer(r["h"], U) for r in got] or [np.zeros(0, U)])
    counts = np.concatenate([np.frombuffer(r["c"], np.int64) for r in got] or [np.zeros(0, np.int64)])
    by = np.argsort(keys)
    keys, counts = keys[by], counts[by]
    return Model(keys, counts, tokens, distinct, order, mu, threshold, buckets), table


def _runs_of(batches: Iterator[pa.RecordBatch], col: str) -> Iterator[pa.Table]:
    """Runs of rows with one value of a column, each as a table."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        x = b.column(b.schema.get_field_index(col)).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(x)) + 1).tolist(), len(x)] if len(x) else []
        for lo, hi in zip(cuts, cuts[1:]):
            if held and x[lo] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = x[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a task's rows as blocks, a row each: number, part, compressed texts, their sizes, lists of the other columns."""
    number = TaskContext.get().partitionId()
    block, held, rows, size = number << 32, [], 0, 0

    def out() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        texts = t.column("_text").to_pylist()
        names = t.schema.names[1:]
        lists = [pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(k).combine_chunks())
                 for k in names]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([(number + block) % PARTS], pa.int32()),
             pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True)], pa.binary()),
             pa.array([np.array([len(x) for x in texts], "<i8").tobytes()], pa.binary()), *lists],
            names=["_block", "_part", "_texts", "_sizes", *names])

    for b in batches:
        begin = 0
        for i, (t,) in enumerate(rows_of(b, "_text")):
            if rows and (size + len(t) > SCORED_BYTES or rows >= SCORED_TEXTS):
                held.append(b.slice(begin, i - begin))
                yield out()
                block, held, rows, size, begin = block + 1, [], 0, 0, i
            rows, size = rows + 1, size + len(t)
        held.append(b.slice(begin))
    if rows:
        yield out()


def _texts(raw: bytes, sizes: bytes) -> list[bytes]:
    """The texts of a block."""
    at = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))]).tolist()
    raw = pa.decompress(raw, at[-1], "zstd", asbytes=True) if at[-1] else b""
    return [raw[lo:hi] for lo, hi in zip(at, at[1:])]


def _answers(blocks: DataFrame, table: DataFrame, order: int, buckets: int) -> DataFrame:
    """``(_block, _bucket, _levels)``: the levels of each block's distinct n-grams, in the order of their hashes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, raw, sizes in rows_of(b, "_block", "_texts", "_sizes"):
                h, _ = _asked(*token_hashes(_texts(raw, sizes)), order)
                some, at = _dealt(h, buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array([block] * len(some), pa.int64()),
                     pa.array([coded(h[lo:hi]) for lo, hi in zip(at, at[1:])], pa.binary())],
                    names=["bucket", "block", "x"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, filt = None, None
        for b in batches:
            for t in _runs_of(iter([b]), "bucket"):
                rows = list(zip(t.column("block").to_pylist(), t.column("x").to_pylist()))
                bucket = t.column("bucket")[0].as_py()
                if bucket != now:  # the segment comes first, if the bucket has one
                    segment = [np.frombuffer(x, U) for block, x in rows if block < 0]
                    now, filt = bucket, Filter(np.array([sum(map(len, segment))]), enumerate(segment))
                rows = [(block, decoded(x)) for block, x in rows if block >= 0]
                if not rows:
                    continue
                levels = filt.levels(np.concatenate([h for _, h in rows])).astype(np.uint8)
                cuts = np.cumsum([0, *(len(h) for _, h in rows)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block for block, _ in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()),
                     pa.array([levels[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary())],
                    names=["_block", "_bucket", "_levels"])

    asked = arrow_map(blocks.select("_block", "_texts", "_sizes"), ask, "bucket int, block long, x binary")
    segments = table.select("bucket", F.lit(-1).cast("long").alias("block"), F.col("segment").alias("x"))
    met = asked.unionByName(segments).repartition("bucket").sortWithinPartitions("bucket", "block")
    return arrow_map(met, look, "_block long, _bucket int, _levels binary")


def score(df: DataFrame, model: Model, table: DataFrame, scratch: Scratch, keep: dict[str, Column],
          text_col: str = "text") -> DataFrame:
    """``keep`` columns plus n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = list(keep)
    src = df.select(text_bytes(text_col).alias("_text"), *(c.alias(k) for k, c in keep.items()))
    kinds = {f.name: f for f in src.schema.fields}
    types = ", ".join(f"{k} {kinds[k].dataType.simpleString()}" for k in names)
    lists = "".join(f", {k} array<{kinds[k].dataType.simpleString()}>" for k in names)

    blocks = scratch.save(arrow_map(src, _blocked, "_block long, _part int, _texts binary, _sizes binary" + lists),
                          "blocks", partition_by=("_part",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for t in _runs_of(batches, "_block"):  # the texts' row, then the answers by bucket
            texts = _texts(t.column("_texts")[0].as_py(), t.column("_sizes")[0].as_py())
            n_tokens, n_known, logs, sums, rest = m.score(texts, t.column("_levels").slice(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(texts), t.column("_block")[0].as_py())), pa.array(np.arange(len(texts), dtype=np.int32)),
                 *(t.column(k)[0].values for k in names), pa.array(n_tokens), pa.array(n_known), pa.array(logs), pa.array(sums),
                 pa.array([x.view(np.int64) for x in rest], pa.list_(pa.int64()))],
                names=["_block", "_row", *names, "n_tokens", "n_known", "logs", "score", "rest"])

    rows: DataFrame | None = None
    for k in range(PARTS):
        part = blocks.filter(F.col("_part") == k).drop("_part")
        both = (part.unionByName(_answers(part, table, model.order, model.buckets), allowMissingColumns=True)
                .repartition("_block").sortWithinPartitions("_block", F.asc_nulls_first("_bucket")))
        done = scratch.save(arrow_map(both, run, f"_block long, _row int, {types}, n_tokens long, n_known long, "
                                                 "logs double, score double, rest array<long>"), f"scored{k}", tidy=True)
        rows = done if rows is None else rows.unionByName(done)
    scratch.drop("blocks")
    smoothed = float(np.log10(model.tokens + model.distinct + 1))
    out = [*names, "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
           (F.col("logs") - F.col("n_tokens") * F.lit(smoothed)).alias("base_score"), "score"]
    if model.threshold <= 1:  # every training token's count was broadcast
        return rows.select(*out)
    # Occurrences of other tokens meet their counts in a join.
    threshold = model.threshold

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, c in rows_of(b, "h", "c"):
                h, c = np.frombuffer(h, U), np.frombuffer(c, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[c < threshold].view(np.int64)),
                                                  pa.array(c[c < threshold])], names=["h", "c"])

    seen = arrow_map(table.select("h", "c"), rare, "h long, c long")
    more = (rows.select("_block", "_row", F.explode("rest").alias("h")).join(seen, "h").groupBy("_block", "_row")
            .agg(F.count("*").alias("_known"), F.sum(F.log10(F.col("c") + 1)).alias("_logs")))
    return (rows.drop("rest").join(more, ["_block", "_row"], "left")
            .withColumn("n_known", F.col("n_known") + F.coalesce("_known", F.lit(0)))
            .withColumn("logs", F.col("logs") + F.coalesce("_logs", F.lit(0.0))).select(*out))
