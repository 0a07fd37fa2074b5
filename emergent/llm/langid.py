"""Language identification in two levels: the family first, then one-versus-one SVMs within it.

A text becomes hashed counts of byte trigrams of its lower-cased letters.  One
linear SVM per family (one against the rest) chooses the family; inside it a
linear SVM for every pair of languages votes.  The models are trained on a
bounded sample: of each language the ``per_language`` labelled rows whose id
hashes lowest.  Everything else reads every row and whole texts.

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text when nothing is labelled; a single learned language is always
predicted, with score 1; ties go to the name that sorts first; repeated rows
and ids are predicted alike; an empty table gives an empty one; texts of any
length are counted whole, in pieces; other columns may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emergent.llm.common import Scratch, arrow_map, rows_of

#: ISO 639-1 codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nb", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
}
UNKNOWN = "und"

#: Hashed feature space, bytes of a text that are counted at a time.
DIMENSIONS = 4096
BLOCK = 1 << 20

#: Characters that may be letters; numerals like a half are not.
_LETTER = re.compile(r"[^\W\d_]")
#: Parts of a language whose first rows are found apart.
PARTS = 8
#: ASCII bytes that are no letters count as blanks.
_BLANKED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether any character is a letter."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def family_of(lang: str) -> str:
    """The family of a language value."""
    code = lang.strip().lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"only {lang}")


def features(text: str) -> np.ndarray:
    """Length-normalised square roots of hashed byte-trigram counts."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_BLANKED) + b" ", dtype=np.uint8)
    counts = np.zeros(DIMENSIONS)
    for lo in range(0, len(raw) - 2, BLOCK):
        b = raw[lo:lo + BLOCK + 2].astype(np.uint32)
        key = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[b[1:-1] != 32]
        counts += np.bincount((key * np.uint32(2654435761) >> 20).astype(np.int64), minlength=DIMENSIONS)
    x = np.sqrt(counts)
    return (x / max(np.linalg.norm(x), 1e-12)).astype(np.float32)


def _svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) and slope of a linear SVM by dual coordinate descent; ``y`` is +1 or -1."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    alpha, w, square = np.zeros(len(y)), np.zeros(x1.shape[1]), (x1 * x1).sum(axis=1)
    rng = np.random.default_rng(0)
    # Classes weigh alike, however many rows each has.
    most = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (x1[i] @ w) - 1) / square[i], 0), most[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x1[i]
                alpha[i] = new
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: Steepness that turns an SVM margin (1 at the support vectors) into a probability.
SLOPE = 4.0


class Model:
    """The trained hierarchy: small arrays that travel with the prediction task."""

    def __init__(self, x: np.ndarray, lang: list[str]):
        self.languages = sorted(set(lang))
        of = np.array([family_of(v) for v in lang])
        self.families = sorted(set(of.tolist()))
        self.members = [[v for v in self.languages if family_of(v) == f] for f in self.families]
        self.family_w = np.array([_svm(x, np.where(of == f, 1.0, -1.0)) for f in self.families]) \
            if len(self.families) > 1 else None
        names = np.array(lang)
        self.pairs = {(a, b): _svm(x[(names == a) | (names == b)],
                                   np.where(names[(names == a) | (names == b)] == a, 1.0, -1.0))
                      for group in self.members for a, b in combinations(group, 2)}

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score of one text."""
        if not self.languages or text is None or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), np.float32(1))
        score, k = 1.0, 0
        if self.family_w is not None:
            p = _sigmoid(SLOPE * (self.family_w @ x))
            k = int(p.argmax())
            score = float(p[k] / p.sum()) if len(p) > 2 else float(_sigmoid(SLOPE / 2 * (
                self.family_w[k] - self.family_w[1 - k]) @ x))
        group = self.members[k]
        votes = np.zeros(len(group))
        for i, j in combinations(range(len(group)), 2):
            a = float(_sigmoid(SLOPE * (self.pairs[group[i], group[j]] @ x)))
            votes[i] += a
            votes[j] += 1 - a
        if len(group) > 1:
            best = int(votes.argmax())
            return group[best], score * float(votes[best]) / (len(group) - 1)
        return group[0], score


def held_out(id_col: str, mod: int = 4, remainder: int = 2) -> Column:
    """Whether the checksum of the id as text leaves that remainder (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == remainder, F.lit(False))


def train(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = 500) -> Model:
    """Fit the hierarchy on at most ``per_language`` labelled rows of each language.

    The rows are chosen on ids and hashes alone, in two levels: the first of each
    of ``PARTS`` parts of a language, then of the language, so a language that
    holds most rows is at most ``PARTS * per_language`` rows in one task.  They are
    joined back for their texts, equal rows counting once; only their feature
    vectors reach the driver: 16 kB a row, ``per_language`` rows a language.
    """
    rows = (df.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).cast("string").alias("text"))
            .filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull())
            .withColumn("row", F.xxhash64("text")))
    narrow = rows.select("id", "lang", "row", F.xxhash64("id").alias("hash"))
    order = [F.col("hash"), F.col("id"), F.col("row")]
    for key in ([F.col("lang"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PARTS))], [F.col("lang")]):
        narrow = narrow.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))) \
            .filter(F.col("n") <= per_language)
    chosen = scratch.save(narrow.select("id", "lang", "row").distinct(), "chosen")
    # Bounded by per_language rows a language, so this side may be broadcast.
    texts = rows.join(F.broadcast(chosen), ["id", "lang", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for b in batches:
            some = []
            for i, lang, row, t in rows_of(b, "id", "lang", "row", "text"):
                if (i, lang, row) not in seen and has_letter(t):
                    some.append({"id": i, "lang": lang, "row": row, "x": features(t).tobytes()})
                seen.add((i, lang, row))
            yield pa.RecordBatch.from_pylist(some, schema=pa.schema(
                [("id", pa.string()), ("lang", pa.string()), ("row", pa.int64()), ("x", pa.binary())]))

    vectors = arrow_map(texts.select("id", "lang", "row", "text"), run, "id string, lang string, row long, x binary")
    got = sorted((r["lang"], bytes(r["x"])) for r in vectors.distinct().collect())
    x = np.array([np.frombuffer(v, np.float32) for _, v in got]) if got else np.zeros((0, DIMENSIONS), np.float32)
    return Model(x, [lang for lang, _ in got])


def predict(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score)`` per row."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            said = [m.predict(t) for t, in rows_of(b, "text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                names=["id", "lang_pred", "score"])

    return arrow_map(src, run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def kept(df: DataFrame, model: Model, *, text_col: str = "text", least_score: float = 0.3) -> DataFrame:
    """The rows whose language is recognised with that score; columns unchanged, nothing shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            said = [m.predict(t) for t, in rows_of(b, text_col)]
            yield b.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in said], pa.bool_()))

    return df.mapInArrow(run, df.schema)
