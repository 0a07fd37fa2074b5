"""Benchmark passages in documents: SimHash of item-sized windows, multi-index blocks, exact verification.

For every item length, each window of a document with that many words gets a
fingerprint, the majority of its shingles' hashes; prefix sums make a window one
subtraction.  The fingerprints of the items of that length lie in a multi-index
of 8 blocks of 8 bits: within 23 bits some block differs in at most 2, and each
block's table holds every value at most 2 flips away, so no item within the
radius is missed.  Candidates within the radius are verified by the weighted
(multiplicity) Jaccard similarity of their shingles, 0.8 or more.

Windows without any shingle of any item have similarity 0 and get no
fingerprint.  Words are runs of letters and digits, lower-cased; a shingle is
five words; an item of fewer words is one shingle of all its words.

Defined results: null or empty texts hold nothing; an item without words is in
no document; repeated documents and items each have their rows; a null document
id is kept; an item without an id is found like any other, and its row has a null
item id; of equally similar windows the first counts; texts of any length are
read whole; an empty table on either side gives no rows; other columns may have
any names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import arrow_map, rows_of

SHINGLE, SIMILARITY = 5, 0.8
#: With 8 blocks, 23 bits are the largest radius that 2 flips a block cover.
RADIUS, BLOCKS, FLIPS = 23, 8, 2
#: Items, and bytes of their texts, that one pass over the documents carries.
ITEMS_A_PASS, BYTES_A_PASS = 20_000, 64 << 20
#: Pairs of windows and items whose blocks are looked up at once.
PAIRS_AT_ONCE = 1 << 25

#: Positions of a text whose prefix sums are held at a time.
REGION = 1 << 14

_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower()) if text else []


def _spread(h: np.ndarray) -> np.ndarray:
    """A bijection that mixes all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _shingles(ids: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the runs of ``k`` words, from the words' hashes."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * _MULTIPLIER + ids[i:i + n]
    return _spread(h)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(ones: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view("<u8").ravel()


class Items:
    """The benchmark's words, shingles and multi-index; what one pass carries."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.hash: dict[str, int] = {}
        self.by_size: dict[int, list[tuple[int, Counter]]] = defaultdict(list)
        fps: dict[int, list[int]] = defaultdict(list)
        known: dict[int, set[int]] = defaultdict(set)
        for number, (item, text) in enumerate(items):
            # Without an id an item is known by its place, told from ids by its type.
            item = f"{number:09d}" if item is None else item
            w = words_of(text)
            if not w:  # in no document
                continue
            for x in w:
                self.hash.setdefault(x, xxhash.xxh64_intdigest(x))
            h = _shingles(np.array([self.hash[x] for x in w], np.uint64), min(SHINGLE, len(w)))
            self.by_size[len(w)].append((item, Counter(h.tolist())))
            fps[len(w)].append(int(_pack(_bits(h).sum(axis=0, dtype=np.int64)[None], len(h))[0]))
            known[min(SHINGLE, len(w))].update(h.tolist())
        self.known = {k: np.sort(np.array(list(v), np.uint64)) for k, v in known.items()}
        self.fps = {n: np.array(v, np.uint64) for n, v in fps.items()}
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= FLIPS
        # For each size and block: rows are the block's values, columns the items.
        self.index = {n: [near[:, (v >> np.uint64(8 * b) & np.uint64(255)).astype(np.int64)] for b in range(BLOCKS)]
                      for n, v in self.fps.items()}

    def candidates(self, size: int, fps: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(window, item, distance)`` of all pairs within the radius."""
        step = max(1, PAIRS_AT_ONCE // len(self.fps[size]))
        for lo in range(0, len(fps), step):
            part = fps[lo:lo + step]
            hit = np.zeros((len(part), len(self.fps[size])), dtype=bool)
            for b, table in enumerate(self.index[size]):
                hit |= table[(part >> np.uint64(8 * b) & np.uint64(255)).astype(np.int64)]
            w, i = np.nonzero(hit)
            d = np.bitwise_count(part[w] ^ self.fps[size][i])
            keep = d <= RADIUS
            yield from zip((w[keep] + lo).tolist(), i[keep].tolist(), d[keep].tolist())

    def found(self, text: str | None) -> list[tuple[int, float, int, int, int]]:
        """Per item in a text its best window: ``(item, similarity, first word, words, distance)``."""
        w = words_of(text)
        get = self.hash.get
        ids = np.fromiter((get(x, 0) for x in w), dtype=np.uint64, count=len(w))
        out: dict[int, tuple[float, int, int, int]] = {}
        for k, known in self.known.items():
            h = _shingles(ids, k)
            at = np.searchsorted(known, h)
            here = np.flatnonzero((known[np.minimum(at, len(known) - 1)] == h))
            if not len(here):
                continue
            # The few texts that hold any known shingle: now with the other words' own hashes.
            full = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
            h = _shingles(full, k)
            sizes = [n for n in self.fps if min(SHINGLE, n) == k]
            reach = max(sizes)
            # Far-apart hits are regions of their own, and a region is cut where it gets long: a window across
            # a cut holds a hit on at least one side and is seen there.
            for part in np.split(here, np.flatnonzero((np.diff(here) > reach) | (np.diff(here // REGION) > 0)) + 1):
                self._region(h, k, sizes, int(part[0]), int(part[-1]), out)
        return [(None if isinstance(item, str) else item, *best)
                for item, best in sorted(out.items(), key=lambda x: (isinstance(x[0], str), x[0]))]

    def _region(self, h: np.ndarray, k: int, sizes: list[int], first: int, last: int,
                out: dict[int, tuple[float, int, int, int]]) -> None:
        """All windows that hold a known shingle between two positions."""
        lo = max(0, first - max(sizes))
        part = h[lo:last + max(sizes) + 1]
        sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(_bits(part), axis=0, dtype=np.int32)])
        for size in sizes:
            n = size - k + 1
            starts = np.arange(max(0, first - n + 1 - lo), min(last - lo, len(part) - n) + 1)
            if not len(starts):
                continue
            for s, i, d in self.candidates(size, _pack(sums[starts + n] - sums[starts], n)):
                item, ours = self.by_size[size][i]
                at = int(starts[s])
                theirs = Counter(part[at:at + n].tolist())
                common = sum(min(c, theirs[x]) for x, c in ours.items())
                alike = common / (2 * n - common)
                best = out.get(item)
                if alike >= SIMILARITY and (best is None or (-alike, at + lo) < (-best[0], best[1])):
                    out[item] = (alike, at + lo, size, d)


def contaminated(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: ``(id_col, item_id, similarity, start_word, n_words, distance)``.

    The benchmark travels with the tasks, ``ITEMS_A_PASS`` items at a time; the
    documents are read once for each such block and never shuffled.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, item_id long, similarity double, start_word long, n_words long, distance int"
    out: DataFrame | None = None
    for shared in _passes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for b in batches:
                rows = [(i, *hit) for i, t in rows_of(b, "id", "text") for hit in known.found(t)]
                cols = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _TYPES)], names=_NAMES)

        one = arrow_map(src, run, schema)
        out = one if out is None else out.unionByName(one)
    return out.withColumnRenamed("id", id_col)


def clean(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item; columns unchanged, nothing shuffled."""
    for shared in _passes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for b in batches:
                yield b.filter(pa.array([not known.found(t) for t, in rows_of(b, text_col)], pa.bool_()))

        df = df.mapInArrow(run, df.schema)
    return df


def _passes(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[Broadcast]:
    """The items in broadcasts of about ``ITEMS_A_PASS`` each (one, if there are none)."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"),
                             F.col(item_text_col).cast("string").alias("text")).filter("text is not null")
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, -(-count // ITEMS_A_PASS), -(-size // BYTES_A_PASS))
    for p in range(passes):
        # An item's texts stay together; those without an id are items of their own.
        block = items.filter(F.pmod(F.xxhash64(F.coalesce("item", F.xxhash64("text"))), F.lit(passes)) == p)
        rows = sorted(((r["item"], r["text"]) for r in block.distinct().collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast(Items(rows))


_NAMES = ["id", "item_id", "similarity", "start_word", "n_words", "distance"]
_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
