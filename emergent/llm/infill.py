"""Fill-in-middle: texts cut at units by a learned rank index, reordered, and put together again.

A text is a row of units (lines by default).  The offsets of all unit
boundaries, as a function of their rank, are kept as a piecewise-linear learned
index: a greedy cone fits segments whose line misses no offset by more than a
bound, and one byte per boundary stores what it misses.  A cut's rank is looked
up among the segments, its offset predicted by the line in integer arithmetic
and corrected by the stored residual, so every cut is exact.

Defined results: a null text is empty, and an empty text stays plain (no
units); a text that holds a marker stays plain; a null id is written as no
digits; equal ids get equal draws, each row on its own; a text of any length is
indexed whole, in pieces; an empty table gives an empty one; other columns are
kept, but one that bears the name of an added column is replaced by it.  Rows
are cut each on its own, so a hot id or source is no group at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.llm.common import arrow_map

#: A line misses an offset by at most this much, so a residual is one signed byte.
BOUND = 127
#: Fraction bits of a segment's slope.
SLOPE_BITS = 24
#: Most ranks of a segment, so that the rounding of its slope adds up to less than one.
LONGEST = 1 << SLOPE_BITS
#: Code points that are searched for boundaries at once.
PIECE = 1 << 20
#: Bytes of output after which a batch is handed on.
FLUSH = 8 << 20
#: What the transformation adds to a row.
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def boundaries(text: str) -> np.ndarray:
    """Code-point offsets of the ends of ``[^\\n]*\\n|[^\\n]+`` units, from 0 (rank 0) to the length (rank n)."""
    ends = [np.zeros(1, np.int64)]
    for lo in range(0, len(text), PIECE):
        points = np.frombuffer(text[lo:lo + PIECE].encode("utf-32-le"), "<u4")
        ends.append(np.flatnonzero(points == 10) + (lo + 1))
    out = np.concatenate(ends)
    return out if out[-1] == len(text) else np.append(out, len(text))


@dataclass
class RankIndex:
    """Error-bounded segments over ``rank -> offset`` with the residuals that make them exact."""

    first: np.ndarray      # a segment's first rank
    base: np.ndarray       # its offset there
    slope: np.ndarray      # offsets per rank, in 2 ** -SLOPE_BITS
    residual: np.ndarray   # one signed byte per rank

    @staticmethod
    def fit(offsets: np.ndarray, bound: int = BOUND) -> RankIndex:
        """The longest segments, from left to right, whose cone of slopes is not empty."""
        if not 1 <= bound <= 127:
            raise ValueError("bound must be 1 to 127")
        first, base, slope = [], [], []
        at, n = 0, len(offsets)
        while at < n:
            # One less than the bound: a slope rounded down to its grid misses by less than 1 more.
            size, low, high, width = 1, 0.0, np.inf, 16
            most_ranks = min(n - at, LONGEST)
            while size < most_ranks:
                x = np.arange(size, min(size + width, most_ranks))
                y = offsets[at + x] - offsets[at]
                least = np.maximum(np.maximum.accumulate((y - (bound - 1)) / x), low)
                most = np.minimum(np.minimum.accumulate((y + (bound - 1)) / x), high)
                apart = np.flatnonzero(least > most)
                fits = int(apart[0]) if len(apart) else len(x)
                if fits:
                    low, high, size = float(least[fits - 1]), float(most[fits - 1]), size + fits
                if fits < len(x):
                    break
                width *= 2
            first.append(at)
            base.append(int(offsets[at]))
            slope.append(int((low + high) / 2 * (1 << SLOPE_BITS)) if size > 1 else 0)
            at += size
        index = RankIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope, np.int64),
                          np.zeros(0, np.int8))
        missed = offsets - index.predict(np.arange(n))
        if len(missed) and int(np.abs(missed).max()) > bound:
            raise AssertionError("a segment missed an offset by more than its bound")
        index.residual = missed.astype(np.int8)
        return index

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets on the segments' lines, in integers."""
        s = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[s] + (self.slope[s] * (ranks - self.first[s]) >> SLOPE_BITS)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of some ranks: predicted, then corrected."""
        return self.predict(ranks) + self.residual[ranks]

    @property
    def units(self) -> int:
        return len(self.residual) - 1


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 of a row: 8-digit groups of the sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = 7,
                markers: tuple[str, str, str] = ("<P>", "<S>", "<M>"), fim_percent: int = 100, spm_percent: int = 50,
                bound: int = BOUND) -> DataFrame:
    """All rows of ``df`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    The prefix ends after the smaller of two drawn ranks, the middle after the
    larger, the suffix is the rest.  ``plain`` rows keep their text.
    """
    if len(set(markers)) < 3 or not all(len(m) > 1 and m[0] not in m[1:] for m in markers):
        raise ValueError("three different markers are needed, each with a first character that it does not repeat")
    kept = [f for f in df.schema.fields if f.name not in ADDED]
    own = "_fim"
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    names, text_name = [f"{own}{i}" for i in range(4)], text_col if text_col not in ADDED else f"{own}text"
    more = [F.col(text_col).alias(text_name)] if text_name != text_col else []
    src = df.select(*(f.name for f in kept), *more, *(c.alias(n) for n, c in zip(names, draws(id_col, seed))))
    schema = T.StructType(kept + [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                                  T.StructField("prefix_chars", T.LongType()),
                                  T.StructField("middle_chars", T.LongType()),
                                  T.StructField("output", T.StringType())])
    p, s, m = markers

    def one(text: str | None, h: tuple[int, ...]) -> tuple:
        text = text or ""
        index = RankIndex.fit(boundaries(text), bound)
        n = index.units
        if not n or h[2] % 100 >= fim_percent or any(x in text for x in markers):
            return n, "plain", None, None, text
        a, b = (int(x) for x in index.offsets(np.sort(np.array([h[0] % (n + 1), h[1] % (n + 1)]))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < spm_percent:
            return n, "spm", a, b - a, "".join((s, suffix, p, prefix, m, middle))
        return n, "psm", a, b - a, "".join((p, prefix, s, suffix, m, middle))

    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_name))
            hs = list(zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in names)))
            got: list[tuple] = []
            size = begin = 0
            for i, h in enumerate(hs):
                got.append(one(texts[i].as_py(), h))
                size += len(got[-1][4])
                if size > FLUSH or i + 1 == len(hs):
                    part = batch.slice(begin, len(got))
                    added = [pa.array(c, t) for c, t in zip(zip(*got), types)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], *added], names=schema.names)
                    got, size, begin = [], 0, i + 1

    return arrow_map(src, run, schema)


def restored(form: str | Column, output: str | Column,
             markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that an output came from.

    No text that was reordered holds a marker, and a marker's first character
    stands nowhere else in it, so a marker's place is its first occurrence.
    """
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))
    p, s, m = markers

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.split(F.substring(output, len(first) + 1, 2147483647), _quoted(second), 2)
        rest = F.split(body[1], _quoted(m), 2)
        return body[0], rest[0], rest[1]

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(prefix, middle, suffix))


def _quoted(marker: str) -> str:
    """The marker as a regular expression that means itself."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in marker)
