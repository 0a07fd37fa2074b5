"""Phrase collocations: counts by multikey quicksort of suffix pointers, scored at their weakest cut.

1. Words are counted per language.  Two fixed-size bitmaps of hashes then say
   which words, and which pairs of words, may be frequent: a pair's bit is set
   when its hash was counted often enough.  They are broadcast, never grow with
   the corpus, and err only towards more work.
2. Every position whose leading pair may be frequent becomes a suffix of at most
   ``longest`` words, cut where a pair cannot be frequent.  Equal suffixes of a
   block are one record with a weight.  Records are routed by language and
   leading pair, so a phrase's suffixes meet in one place.
3. There a multikey three-way quicksort partitions the suffix pointers word by
   word: the weight of an equal partition is the count of its words, and a
   partition below the least count is abandoned with all that it holds.
4. Counts are joined to the cuts, the weakest cut scores the phrase, phrases
   that a longer one nearly always holds go, and the best of each language stay.

A leading pair with more than a 4096th of all occurrences is hot: its suffixes
are dealt by all their words and their partial counts are added afterwards, so
no pair is one task's work.

Defined results: a null text is empty, a null language is ``und``; empty texts
and empty tables give no rows; copies count as often as they occur; ties go by
count, then by phrase in byte order; ids are not used, so null or repeated ones
do not matter; texts of any length are read whole, a worker holds one at a time
beside its block; other columns of the table may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of, text_bytes

#: A-Z to a-z, the ends of pieces to a line feed, tabs to blanks.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
              for b in range(256))
#: Bytes of text that are numbered and combined at once.
BLOCK = 6 << 20
#: Distinct words that a task counts before it hands them on.
VOCABULARY = 1 << 18
#: log2 of the bits of a filter of possibly frequent words or pairs (16 MiB).
FILTER_BITS = 27
#: A pair is hot above this share of all occurrences; so there are fewer hot pairs than its inverse.
HOT_SHARE = 1 / 4096
#: Suffixes that are sorted at once: runs of whole routes of at least so many.
SORTED = 1 << 18
#: Parts of a language whose best phrases are found apart.
PARTS = 16
_SEED = 42


def _tokens(text: bytes) -> list[bytes]:
    """Words and, between pieces, line feeds; empty strings mean nothing."""
    return text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Per language the texts of a block, a line feed between them."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for b in batches:
        for lang, text in rows_of(b, "lang", "text"):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= BLOCK:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, word, f)`` of ``texts(lang, text binary)``; words as UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            langs, ws, fs = [], [], []
            for lang, c in counts.items():
                c.pop(b"", 0)
                c.pop(b"\n", 0)
                langs += [lang] * len(c)
                ws += c.keys()
                fs += c.values()
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ws, pa.binary()),
                                               pa.array(fs, pa.int64())], names=["lang", "word", "f"])

        for lang, text in _blocks(batches):
            counts.setdefault(lang, Counter()).update(_tokens(text))
            if sum(map(len, counts.values())) > VOCABULARY:
                yield out()
        yield out()

    return arrow_map(texts, run, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _bitmap(hashes: DataFrame, bits: int) -> bytes:
    """A filter of the hashes ``h``: one bit for each by its last ``bits`` bits; at most ``2 ** bits`` are collected."""
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    parts = (hashes.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(32767)).alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(max(4096, 1 << (bits - 3)))
    for r in parts.collect():
        out[4096 * r["bucket"]:4096 * (r["bucket"] + 1)] = r["bits"]
    return bytes(out)


def _held(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes a filter may hold."""
    place = h & np.uint64((1 << bits) - 1)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b << np.uint64(29)) | (b >> np.uint64(35)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Numbered:
    """A block's words as numbers (0 between pieces) with their hashes."""

    def __init__(self, lang: str, text: bytes):
        number: dict[bytes, int] = {b"\n": 0}
        tokens = [t for t in _tokens(text) if t]
        for t in set(tokens):
            number.setdefault(t, len(number))
        self.words = list(number)
        self.at = np.fromiter(map(number.__getitem__, tokens), dtype=np.int32, count=len(tokens))
        del tokens
        seed = xxhash.xxh64_intdigest(lang.encode(), _SEED)
        #: As Spark's ``xxhash64(lang, word)``: each value is hashed with the hash before it as the seed.
        self.hash = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))

    def pairs(self, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose word and next word may be frequent, and the pairs' hashes."""
        known = _held(words, self.hash, bits)
        known[0] = False
        ok = known[self.at]
        i = np.flatnonzero(ok[:-1] & ok[1:])
        return i, _mixed(self.hash[self.at[i]], self.hash[self.at[i + 1]])


def _pair_counts(texts: DataFrame, words, bits: int) -> DataFrame:
    """``(h, f)``: hashes of neighbouring possibly frequent words and how often they were met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(words.value, np.uint8)
        for lang, text in _blocks(batches):
            h, n = np.unique(_Numbered(lang, text).pairs(known, bits)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "f"])

    return arrow_map(texts, run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def _suffixes(texts: DataFrame, words, pairs, hot: list[int], bits: int, longest: int) -> DataFrame:
    """``(route, hot, lang, suffix, weight)``: distinct suffixes of a block, cut where no phrase can go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, paired = (np.frombuffer(x.value, np.uint8) for x in (words, pairs))
        crowded = np.array(hot, np.int64).view(np.uint64)
        for lang, text in _blocks(batches):
            block = _Numbered(lang, text)
            i, h = block.pairs(known, bits)
            ok = _held(paired, h, bits)
            i, h = i[ok], h[ok]
            goes_on = np.zeros(len(block.at) + longest, bool)
            goes_on[i] = True
            # The number of words: two, and one more for each further pair in a row.
            size = np.full(len(i), 2)
            for k in range(1, longest - 1):
                size += goes_on[i + k] & (size == k + 1)
            base, key = len(block.words), block.at[i].astype(np.int64)
            padded = np.append(block.at, np.zeros(longest, np.int32))
            for k in range(1, longest):
                # Equal numbers so far and equal next words (0 past the end) are equal numbers again.
                key = np.unique(key * base + np.where(k < size, padded[i + k], 0), return_inverse=True)[1]
            first, weight = np.unique(key, return_index=True, return_counts=True)[1:]
            route, is_hot = h[first], np.isin(h[first], crowded)
            word = block.words.__getitem__
            rows = np.stack([padded[i[first] + k] for k in range(longest)], axis=1)
            texts_: list[bytes] = []
            for lo in range(0, len(rows), 1 << 16):
                texts_ += [b" ".join(map(word, r[:n])) for r, n in zip(rows[lo:lo + (1 << 16)].tolist(),
                                                                      size[first[lo:lo + (1 << 16)]].tolist())]
            spread = np.array([xxhash.xxh64_intdigest(t, _SEED) if x else 0 for t, x in zip(texts_, is_hot.tolist())],
                              np.uint64)
            route = np.where(is_hot, spread, route)
            for lo in range(0, len(texts_), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route[s].view(np.int64)), pa.array(is_hot[s]), pa.array([lang] * len(texts_[s])),
                     pa.array(texts_[s], pa.binary()), pa.array(weight[s])],
                    names=["route", "hot", "lang", "suffix", "weight"])

    return arrow_map(texts, run, "route long, hot boolean, lang string, suffix binary, weight long")


def equal_partitions(at: np.ndarray, pointers: np.ndarray, weights: np.ndarray, depth: int, deepest: int,
                     least: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of suffix pointers: ``(a pointer, its depth, count)`` of the equal partitions.

    ``at`` holds the words' numbers, 0 after each suffix.  From ``depth`` words
    on, which are equal, pointers are parted by their next word against a
    pivot's: less and greater go on at the same depth, equal ones a word deeper.
    A partition that weighs less than ``least`` is abandoned.
    """
    todo = [(pointers, weights, depth)]
    while todo:
        p, w, d = todo.pop()
        total = int(w.sum())
        if total < least or not len(p):
            continue
        key = at[p + d]
        pivot = key[len(key) >> 1]
        same = key == pivot
        if same.all():
            count = total
        else:
            under = key < pivot
            over = ~(under | same)
            todo += [(p[under], w[under], d), (p[over], w[over], d)]
            p, w = p[same], w[same]
            count = int(w.sum())
        if pivot == 0 or count < least:
            continue
        yield int(p[0]), d + 1, count
        if d + 1 < deepest:
            todo.append((p, w, d + 1))


def _sorted_counts(langs: list[str], suffixes: list[bytes], weights: np.ndarray, longest: int,
                   least: int) -> Iterator[tuple[str, bytes, int, int]]:
    """``(lang, phrase, words, count)`` of two words or more among suffixes whose routes are whole."""
    number: dict[bytes, int] = {}
    at: list[int] = []
    pointers = np.empty(len(suffixes), np.int64)
    by_lang: dict[str, list[int]] = {}
    for k, (lang, s) in enumerate(zip(langs, suffixes)):
        pointers[k] = len(at)
        by_lang.setdefault(lang, []).append(k)
        at += [number.setdefault(w, len(number) + 1) for w in s.split(b" ")]
        at.append(0)
    flat, words = np.array(at, np.int64), [b"", *number]
    for lang, rows in by_lang.items():
        for p, d, count in equal_partitions(flat, pointers[rows], weights[rows], 0, longest, least):
            if d > 1:
                yield lang, b" ".join([words[x] for x in at[p:p + d]]), d, count


def _routed_counts(suffixes: DataFrame, longest: int, least: int) -> DataFrame:
    """``(lang, phrase, words, f)`` of phrases of two words or more with ``f >= least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(routes: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(routes)
            got: list[tuple] = []
            for hot in (False, True):
                part = table.filter(pc.equal(table["hot"], hot))
                # A hot pair's counts are partial here, so the least one applies after they are added.
                got += _sorted_counts(part["lang"].to_pylist(), part["suffix"].to_pylist(),
                                      part["weight"].to_numpy(), longest, 1 if hot else least)
            lang, phrase, words, f = zip(*got) if got else ([], [], [], [])
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.binary()),
                                               pa.array(words, pa.int32()), pa.array(f, pa.int64())],
                                              names=["lang", "phrase", "words", "f"])

        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            route = b.column(0).to_numpy()
            # Only where a route ends may the held ones be sorted.
            ends = np.flatnonzero(route[1:] != route[:-1]) + 1
            if held and len(route) and held[-1].column(0)[-1].as_py() != route[0]:
                ends = np.insert(ends, 0, 0)
            if size + len(route) >= SORTED and len(ends):
                cut = int(ends[-1])
                yield out(held + [b.slice(0, cut)])
                held, size, b = [], 0, b.slice(cut)
            if b.num_rows:
                held.append(b)
                size += b.num_rows
        if held:
            yield out(held)

    parts = arrow_map(suffixes.repartition("route").sortWithinPartitions("route"), run,
                      "lang string, phrase binary, words int, f long")
    return parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def phrase_counts(df: DataFrame, scratch: Scratch, lang_col: str = "lang", text_col: str = "text", *,
                  longest: int = 4, least: int = 30, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Saved ``(lang, phrase, words, f)`` of 1 to ``longest`` words with ``f >= least``, and ``(lang, n)`` of all words."""
    if not 2 <= longest <= 16 or least < 1 or not 15 <= filter_bits <= 30:
        raise ValueError("longest must be 2 to 16, least at least 1, filter_bits 15 to 30")
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      text_bytes(text_col).alias("text"))
    counted = scratch.save(word_counts(texts), "words")
    n = scratch.save(counted.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    frequent = counted.filter(F.col("f") >= least)
    words = spark.sparkContext.broadcast(
        _bitmap(frequent.select(F.xxhash64("lang", "word").alias("h")), filter_bits))
    pairs = scratch.save(_pair_counts(texts, words, filter_bits).filter(F.col("f") >= least), "pairs")
    total = n.agg(F.sum("n")).first()[0] or 0
    # Fewer than 1 / HOT_SHARE pairs can be as frequent as this.
    hot = [r["h"] for r in pairs.filter(F.col("f") > max(total * HOT_SHARE, least)).select("h").collect()]
    paired = spark.sparkContext.broadcast(_bitmap(pairs.select("h"), filter_bits))
    longer = _routed_counts(_suffixes(texts, words, paired, hot, filter_bits, longest), longest, least)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
    return scratch.save(single.unionByName(longer), "phrases"), n


def _part(phrase: str, first: int, count: int) -> Column:
    """Some words of a phrase in a row, as text."""
    return F.array_join(F.slice(phrase, first + 1, count), " ")


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", *, longest: int = 4, least: int = 30,
                 scale: int = 2_000_000, held_percent: int = 80, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    A phrase's score is the least over its cuts of ``floor(scale * a / (l + r))``,
    ties to the first cut, in exact decimals.  A phrase goes if a longer one with
    ``100 * f >= held_percent * a`` holds its words in a row.
    """
    scratch = Scratch(df.sparkSession, "phrases")
    counts, n = phrase_counts(df, scratch, lang_col, text_col, longest=longest, least=least)
    counts = counts.withColumn("phrase", F.col("phrase").cast("string"))
    parts = counts.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("f").alias("p_f"))
    many = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"),
                                             F.split("phrase", " ").alias("w"))
    cuts = many.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("w", F.lit(0), F.col("k")).alias("left"),
                       _part("w", F.col("k"), F.col("words") - F.col("k")).alias("right"))

    def met(rows: DataFrame, side: str, name: str) -> DataFrame:
        on = (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("part"))
        return rows.join(parts, on).drop("p_lang", "part", side).withColumnRenamed("p_f", name)

    cuts = met(met(cuts, "left", "l"), "right", "r")
    score = F.expr(f"(CAST({scale} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0))) DIV CAST(l + r AS DECIMAL(20,0))")
    weakest = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
               .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # All shorter runs of words of every candidate, with the count of the most frequent one that holds them.
    inner = many.filter("words > 2").select(
        "lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("size"))).alias("i"))
    inner = (inner.select("lang", "a", _part("w", F.col("i"), F.col("size")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("holder")))
    left = (weakest.join(inner, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("holder") < held_percent * F.col("a"), F.lit(True))))
    # In two levels: the last one reads at most PARTS * top phrases of a language.
    best = left
    for key in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(PARTS))], [F.col("lang")]):
        order = Window.partitionBy(*key).orderBy(F.desc(F.col("cut.score")), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"),
                                       F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
