"""Personal data: patterns as a base, and a semi-Markov conditional random field that adds spans.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone numbers
by fixed patterns and checks.  The field reads the neighbourhoods of digits and
at-signs.  A neighbourhood is cut into atoms; a segmentation covers the atoms
with segments, each an entity of at most ``LONGEST`` atoms or a single atom
outside.  A segment's score comes from features of the whole span (its shape,
digit count, checksum, group sizes, separators, the characters and cue words
around it), plus a weight for the pair of labels that meet.  Viterbi over
bounded segments chooses boundaries and types together.  Entities that overlap
no base span are added to it.

Training maximises the conditional likelihood (forward sums over all
segmentations) on a bounded sample of neighbourhoods whose reference
segmentation comes from the base patterns; a copy of each is rewritten by rules
(a phone number without its plus, other separators, a spelled-out at-sign), so
that the field learns shapes that the patterns miss, and another is spoiled (a
wrong checksum, a date), so that it learns what is none.  Long or many
neighbourhoods cost time in proportion.

Defined results: a null or empty text has no spans; positions count code points;
repeated rows and ids have the same result; with nothing to train on the field
adds nothing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import arrow_map, rows_of

KINDS = ("email", "ip", "card", "phone")
#: Most atoms of an entity.
LONGEST = 39

# The characters and patterns of the base.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")

#: What a text with personal data must hold.
_ANY = re.compile(r"[0-9@]|[\[(] ?at ?[\])]", re.I)


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _digits(s: str) -> str:
    return _NON_DIGIT.sub("", s)


def _small(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in a row: whether one ends is decided after its at-sign, where it starts before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > free and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            yield lo, m.end()
            free = m.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` of the pattern matches that pass their checks, in order.

    Each search is linear in the text: a chain of dotted numbers holds the
    matches of four parts one after the other.
    """
    out = [(lo, hi, 0) for lo, hi in _emails(text)] if "@" in text else []
    for chain in _DOTTED.finditer(text) if "." in text else ():
        if text.count(".", *chain.span()) < 3:
            continue
        parts = list(_PART.finditer(text, *chain.span()))
        for k in range(0, len(parts) - 3, 4):
            if all(_small(p.group()) for p in parts[k:k + 4]):
                out.append((parts[k].start(), parts[k + 3].end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), 2))
    if "+" in text:
        out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out)


# ---- neighbourhoods and atoms -------------------------------------------------

_NUMBERS = re.compile(r"[+(]?[0-9](?:[0-9\x20().+-]{5,}[0-9])")
_SPELLED = r"(?: ?\[ ?{0} ?\] ?| ?\( ?{0} ?\) ?)"
_AT, _DOT = _SPELLED.format("at"), _SPELLED.format("dot")
_MAILS = re.compile(rf"[A-Za-z0-9._%+-]+(?: ?@ ?|{_AT})[A-Za-z0-9-]+(?:(?:\.|{_DOT})[A-Za-z0-9-]+)+", re.I)
_ATOM = re.compile(rf"[0-9]+|{_AT}|{_DOT}|[A-Za-z]+|.", re.I | re.S)
#: Characters left of a span in which cue words count.
CUE = 24
_CUES = (re.compile(r"e-?mail|contact|write|mailto", re.I), re.compile(r"\bip\b|host|server|address|ping", re.I),
         re.compile(r"card|visa|credit|payment|cc\b", re.I), re.compile(r"phone|tel|call|mobile|fax|dial", re.I))


_TRIGGER = re.compile(r"@|[\[(] ?at ?[\])]", re.I)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def mails(text: str) -> list[tuple[int, int]]:
    """Stretches that look like addresses, some spelled out, around each at-sign.

    An address begins where the run of its characters before the sign does, however
    far away; the runs of different signs are apart, so the walk is linear.
    """
    out: list[tuple[int, int]] = []
    for t in _TRIGGER.finditer(text):
        free = out[-1][1] if out else 0
        lo = t.start() - (t.start() > free and text[t.start() - 1] == " ")
        while lo > free and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _MAILS.match(text, lo)
        if m and m.start() < t.start():
            out.append(m.span())
    return out


def neighbourhoods(text: str) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Stretches that may hold an entity, in order and apart, and the addresses in each."""
    if not _ANY.search(text):
        return []
    found = mails(text)
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for lo, hi, mail in sorted([(*m.span(), []) for m in _NUMBERS.finditer(text)]
                               + [(lo, hi, [(lo, hi)]) for lo, hi in found]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]), out[-1][2] + mail)
        else:
            out.append((lo, hi, mail))
    return out


# ---- features of a whole span -------------------------------------------------

_MAIL_SHAPE = re.compile(rf"[A-Za-z0-9._%+-]+(?: ?@ ?|{_AT})[A-Za-z0-9-]+(?:(?:\.|{_DOT})[A-Za-z0-9-]+)*"
                         rf"(?:\.|{_DOT})[A-Za-z]{{2,}}", re.I)
_GROUPED = re.compile(r"(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}")
_FEATURES = ("bias", "mail shape", "plain mail", "four parts", "parts too large", "card length and checksum",
             "card length, no checksum", "plus and phone length", "phone groups", "few digits", "many digits",
             "one bare run", "card groups", "one separator", "letter beside", "digit beside", "cue of kind",
             "other cue", "open bracket", "double blank", "dots only", "long")
N_FEATURES = len(_FEATURES)


def _span_features(text: str, lo: int, hi: int, kind: int) -> list[int]:
    """Numbers of the features that hold for a span as an entity of a kind."""
    s = text[lo:hi]
    d = _digits(s)
    n = len(d)
    out = [0]
    if _MAIL_SHAPE.fullmatch(s):
        out += [1, 2] if _EMAIL.fullmatch(s) else [1]
    if _DOTTED.fullmatch(s) and s.count(".") == 3:
        out.append(3 if all(map(_small, s.split("."))) else 4)
    if 13 <= n <= 19:
        out.append(5 if luhn(d) else 6)
    if s[0] == "+" and 10 <= n <= 15:
        out.append(7)
    if _GROUPED.fullmatch(s):
        out.append(8)
    out += [9] * (n < 9) + [10] * (n > 19)
    groups = [len(g) for g in _NON_DIGIT.split(s) if g]
    if len(groups) == 1 and groups[0] == len(s):
        out.append(11)
    if groups in ([4, 4, 4, 4], [4, 6, 5], [4, 4, 4, 4, 3]):
        out.append(12)
    between = set(_NON_DIGIT.findall(s))
    out += [13] * (len(between) == 1)
    before, after = text[lo - 1:lo], text[hi:hi + 1]
    out += [14] * (before.isalpha() or after.isalpha())
    out += [15] * (before.isdigit() or after.isdigit() or bool(re.fullmatch(r"[0-9][.-]", text[max(0, lo - 2):lo]))
                   or bool(re.fullmatch(r"[.-][0-9]", text[hi:hi + 2])))
    left = text[max(0, lo - CUE):lo]
    for k, cue in enumerate(_CUES):
        if cue.search(left):
            out.append(16 if k == kind else 17)
    out += [18] * (s.count("(") != s.count(")")) + [19] * ("  " in s) + [20] * (between == {"."}) + [21] * (n > 15)
    return out


def _may_be(s: str, kind: int, n: int) -> bool:
    """Cheap limits on what a span of a kind can be."""
    if kind == 0:
        return s[0].isalnum() and s[-1].isalpha() and ("@" in s or "at" in s.lower())
    if not s[-1].isdigit() or s[0] not in "+(0123456789" or any(c.isalpha() or c == "@" for c in s):
        return False
    return (kind == 1 and 4 <= n <= 12 and s.count(".") == 3 and s[0].isdigit()) or \
        (kind == 2 and 13 <= n <= 19 and s[0].isdigit() and not set(s) - set("0123456789 -")) or \
        (kind == 3 and 7 <= n <= 15)


class Lattice:
    """All segments of a neighbourhood: bounded entities with their features, and single atoms outside."""

    def __init__(self, text: str, lo: int, hi: int, mail: list[tuple[int, int]]):
        cuts = [lo]
        for m in _ATOM.finditer(text, lo, hi):
            cuts.append(m.end())
        self.cuts, self.size = cuts, len(cuts) - 1
        #: Per end position the entities that end there: (first atom, kind, feature numbers).
        self.ending: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in cuts]
        starts = [i for i in range(self.size) if text[cuts[i]].isalnum() or text[cuts[i]] in "+("]
        for i in starts:
            digits = 0
            for j in range(i + 1, min(self.size, i + LONGEST) + 1):
                piece = text[cuts[j - 1]:cuts[j]]
                digits += len(piece) if piece[0].isdigit() else 0
                if not piece[-1].isalnum():
                    continue
                near_mail = any(a <= cuts[i] and cuts[j] <= b for a, b in mail)
                if digits < 4 and not near_mail or digits > 19 and not near_mail:
                    if digits > 19 and not mail:
                        break
                    continue
                s = text[cuts[i]:cuts[j]]
                for kind in range(4):
                    if (kind != 0 or near_mail) and _may_be(s, kind, digits):
                        f = np.array(_span_features(text, cuts[i], cuts[j], kind))
                        self.ending[j].append((i, kind, f))

    def gold(self, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
        """Reference entities as ``(first atom, end, kind)``; None if one is no segment here."""
        at = {c: k for k, c in enumerate(self.cuts)}
        out = []
        for lo, hi, kind in spans:
            i, j = at.get(lo), at.get(hi)
            if i is None or j is None or not any(a == i and k == kind for a, k, _ in self.ending[j]):
                return None
            out.append((i, j, kind))
        return out


class Field:
    """Weights: per kind and feature, and per pair of labels (4 is outside)."""

    def __init__(self) -> None:
        self.w = np.zeros((4, N_FEATURES))
        self.pair = np.zeros((5, 5))

    def _scores(self, lat: Lattice) -> list[list[tuple[int, int, float, np.ndarray]]]:
        return [[(i, k, float(self.w[k][f].sum()), f) for i, k, f in ends] for ends in lat.ending]

    def decode(self, lat: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's entities ``(first atom, end, kind)``."""
        best = np.full((lat.size + 1, 5), -math.inf)
        back: list[list[tuple[int, int] | None]] = [[None] * 5 for _ in range(lat.size + 1)]
        best[0, 4] = 0
        for j, ends in enumerate(self._scores(lat)):
            for i, k, s, _ in [*ends, *([(j - 1, 4, 0.0, None)] if j else [])]:
                prev = best[i] + self.pair[:, k]
                p = int(prev.argmax())
                if prev[p] + s > best[j, k]:
                    best[j, k] = prev[p] + s
                    back[j][k] = (i, p)
        out, j, k = [], lat.size, int(best[lat.size].argmax())
        while j and back[j][k]:
            i, p = back[j][k]
            if k != 4:
                out.append((i, j, k))
            j, k = i, p
        return out[::-1]

    def learn(self, lat: Lattice, gold: list[tuple[int, int, int]], rate: float) -> None:
        """A gradient step on the log-likelihood of a segmentation."""
        edges = [(i, j, k, s, f) for j, ends in enumerate(self._scores(lat))
                 for i, k, s, f in [*ends, *([(j - 1, 4, 0.0, None)] if j else [])]]
        fwd = np.full((lat.size + 1, 5), -math.inf)
        fwd[0, 4] = 0
        for i, j, k, s, _ in edges:
            fwd[j, k] = np.logaddexp(fwd[j, k], np.logaddexp.reduce(fwd[i] + self.pair[:, k]) + s)
        total = np.logaddexp.reduce(fwd[lat.size])
        bwd = np.full((lat.size + 1, 5), -math.inf)
        bwd[lat.size] = 0
        dw, dpair = np.zeros_like(self.w), np.zeros_like(self.pair)
        for i, j, k, s, f in reversed(edges):
            here = self.pair[:, k] + s + bwd[j, k]
            bwd[i] = np.logaddexp(bwd[i], here)
            p = np.exp(fwd[i] + here - total)
            dpair[:, k] -= p
            if k != 4:
                np.subtract.at(dw[k], f, p.sum())
        at, last = 0, 4
        for i, j, k in [*gold, (lat.size, lat.size, 4)]:
            while at < i:
                dpair[last, 4] += 1
                at, last = at + 1, 4
            if k != 4:
                f = next(f for a, kind, f in lat.ending[j] if a == i and kind == k)
                np.add.at(dw[k], f, 1)
                dpair[last, k] += 1
                at, last = j, k
        self.w += rate * (dw - 1e-3 * self.w)
        self.pair += rate * (dpair - 1e-3 * self.pair)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """The entities of a whole text as ``(start, end, kind)``."""
        out = []
        for lo, hi, mail in neighbourhoods(text):
            lat = Lattice(text, lo, hi, mail)
            if any(lat.ending):
                out += [(lat.cuts[i], lat.cuts[j], k) for i, j, k in self.decode(lat)]
        return out


# ---- training -----------------------------------------------------------------

def _rewritten(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """A neighbourhood in another spelling, with its entities where they are then."""
    out, at, moved = "", 0, []
    for lo, hi, kind in spans:
        out += text[at:lo]
        s = text[lo:hi]
        if kind == 0:
            who, _, where = s.partition("@")
            s = who + (" [at] ", " (at) ", " @ ")[turn % 3] + where.replace(".", (" [dot] ", ".", " (dot) ")[turn // 3 % 3])
        elif kind == 3:
            d = _digits(s)[-10:]
            s = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[turn % 3]
        elif kind == 2:
            d = _digits(s)
            s = ("-", " ", "")[turn % 3].join(d[i:i + 4] for i in range(0, len(d), 4))
        moved.append((len(out), len(out) + len(s), kind))
        out += s
        at = hi
    return out + text[at:], moved


def _spoiled(text: str, spans: list[tuple[int, int, int]], turn: int) -> str:
    """A neighbourhood whose numbers are no personal data any more: a wrong checksum, too large a part, a date."""
    out, at = "", 0
    for lo, hi, kind in spans:
        out += text[at:lo]
        s = text[lo:hi]
        if kind == 1:
            s = s[:s.rindex(".") + 1] + str(256 + turn % 700)
        elif kind == 2:
            s = s[:-1] + str((int(s[-1]) + 1 + turn % 9) % 10)
        elif kind == 3:
            d = _digits(s)
            s = (f"20{d[:2]}-0{d[-1]}-1{d[-2]} 1{d[-3]}", f"{d[:2]}.{d[2:4]}.20{d[4:6]} - {d[6:8]}", f"{d[:5]}-{d[5:7]}-{d[0]}")[turn % 3]
        out += s if kind else "none"
        at = hi
    return out + text[at:]


def fit(samples: list[str], rounds: int = 4) -> Field:
    """Train on texts around neighbourhoods; the base gives the reference."""
    field, made = Field(), []
    for turn, sample in enumerate(samples):
        base = _apart(base_spans(sample))
        made_from = [(sample, base)]
        if base:
            made_from += [_rewritten(sample, base, turn), (_spoiled(sample, base, turn), [])]
        for text, spans in made_from:
            for lo, hi, mail in neighbourhoods(text):
                lat = Lattice(text, lo, hi, mail)
                gold = lat.gold([s for s in spans if lo <= s[0] and s[1] <= hi])
                if gold is not None and any(lat.ending):
                    made.append((lat, gold))
    rng = np.random.default_rng(0)
    for r in range(rounds):
        for k in rng.permutation(len(made)):
            field.learn(*made[k], rate=0.2 / (1 + r))
    return field


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans without those that overlap an earlier one."""
    out: list[tuple[int, int, int]] = []
    for s in spans:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def _spots(text: str, around: int, at_most: int) -> list[str]:
    """The text around the first neighbourhood and around the first address."""
    spans = [x[:2] for x in neighbourhoods(text)[:1]] + mails(text)[:1]
    return [text[max(0, lo - around):min(hi, lo + at_most) + around] for lo, hi in dict.fromkeys(spans)]


def train(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = 600,
          around: int = 40, at_most: int = 2048) -> Field:
    """Fit the field on the first neighbourhoods of at most ``sample`` rows.

    The rows are those with a digit or at-sign whose id hashes lowest (a top-k,
    limited per task); equal rows count once.  What reaches the driver is
    ``around`` characters on both sides of at most ``at_most``, twice a row.
    """
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("id is not null").filter(F.col("text").rlike("[0-9@]")).withColumn("row", F.xxhash64("text"))
    chosen = (rows.select("id", "row", F.xxhash64("id", F.lit(3)).alias("h")).orderBy("h", "id", "row").limit(sample)
              .select("id", "row").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for b in batches:
            out = []
            for i, row, t in rows_of(b, "id", "row", "text"):
                if (i, row) not in seen:
                    seen.add((i, row))
                    out += [(i, row, n, s) for n, s in enumerate(_spots(t, around, at_most))]
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "row", "n", "spot"), r)) for r in out], schema=pa.schema(
                [("id", pa.string()), ("row", pa.int64()), ("n", pa.int32()), ("spot", pa.string())]))

    # At most ``sample`` rows told apart by id and text: that side may be broadcast.
    spots = arrow_map(rows.join(F.broadcast(chosen), ["id", "row"]).select("id", "row", "text"), run,
                      "id string, row long, n int, spot string").distinct()
    return fit(sorted(r["spot"] for r in spots.collect()))


def find(df: DataFrame, field: Field, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, base, spans)`` per row: arrays of ``(start, end, kind)``, spans being the base and what is added."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            base, spans = [], []
            for text, in rows_of(b, "text"):
                own, more = both(text, model)
                base.append([dict(zip(("start", "end", "kind"), (lo, hi, KINDS[k]))) for lo, hi, k in own])
                spans.append([dict(zip(("start", "end", "kind"), (lo, hi, KINDS[k]))) for lo, hi, k in more])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, kind), pa.array(spans, kind)],
                                             names=["id", "base", "spans"])

    span = "array<struct<start: long, end: long, kind: string>>"
    return arrow_map(src, run, f"id long, base {span}, spans {span}").withColumnRenamed("id", id_col)


def both(text: str | None, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans of a text, and all spans."""
    if not text or not _ANY.search(text):
        return [], []
    base = base_spans(text)
    # The base as stretches apart from one another, so that one look-up tells whether a span meets any.
    starts, ends = [], []
    for lo, hi, _ in base:
        if ends and lo < ends[-1]:
            ends[-1] = max(hi, ends[-1])
        else:
            starts.append(lo)
            ends.append(hi)
    added = []
    for s in field.spans(text):
        k = bisect_left(starts, s[1]) - 1  # the last stretch that starts before the span ends
        if k < 0 or ends[k] <= s[0]:
            added.append(s)
    return base, sorted(base + added)


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for lo, hi, kind in spans:
        if lo >= at:
            out += [text[at:lo], f"<{KINDS[kind]}>"]
        at = max(at, hi)
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, field: Field, *, text_col: str = "text") -> DataFrame:
    """The rows with personal data in the text masked; other columns unchanged."""
    shared = df.sparkSession.sparkContext.broadcast(field)
    place, kind = df.columns.index(text_col), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            text = [masked(t, both(t, model)[1]) for t, in rows_of(b, text_col)]
            yield b.set_column(place, b.schema.field(place), pa.array(text, b.schema.field(place).type))

    return df.mapInArrow(run, kind)
