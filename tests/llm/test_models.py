"""Language model, personal data, languages and decontamination against brute force and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emergent.llm import decontaminate, langid, lm, pii
from emergent.llm.common import Scratch, text_bytes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string, id int"


# ---- language model ---------------------------------------------------------------

def slow_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def scored(spark, rows, **options):
    df = spark.createDataFrame(rows, DOCS)
    out, scratch = langid.held_out("doc_id", 7), Scratch(spark, "t")
    model, table = lm.train(df.filter(~out).select(text_bytes("text").alias("text")), scratch, buckets=16, **options)
    got = lm.score(df, model, table, scratch, {"doc_id": F.col("doc_id"), "held_out": out}).collect()
    return model, got


@pytest.mark.parametrize("options", [{}, {"exact_tokens": 5}, {"order": 3}, {"exact_tokens": 0, "order": 1}])
def test_scores(llm_spark, options):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "The"]
    texts = [None, "", "  ", "new words only"] + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    model, got = scored(llm_spark, rows, **options)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t, *_ in rows if not held(i) for w in [*slow_words(t), " end"])
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for r in got:
        w = [*slow_words(texts[r["doc_id"]]), " end"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held(r["doc_id"]), len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert r["score"] < 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 500, 40_000])
@pytest.mark.parametrize("bits", [3, 17, 46, 64])
def test_coded_hashes_come_back(n, bits):
    h = np.unique(np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64, endpoint=False)
                  if bits < 64 else np.random.default_rng(n).integers(0, (1 << 64) - 1, n, dtype=np.uint64))
    raw = lm.coded(h)
    assert (lm.decoded(raw) == h).all() and len(raw) <= 24 + 8.5 * len(h)
    edge = np.array([0, 1, 255, 256, (1 << 63), (1 << 64) - 1], np.uint64)
    assert (lm.decoded(lm.coded(edge)) == edge).all()


def test_filter_misses_nothing():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    c = rng.zipf(1.4, 5000).clip(1, 10**6)
    seg = lm.build_segment(h, c)
    filt = lm.Filter(np.array([len(seg)]), [(0, seg)])
    low = lm.estimates()[lm.level_of(c)]
    assert (filt.counts(h) >= low - 1e-9).all() and (filt.counts(h) == low).mean() > 0.97
    other = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (filt.counts(other) > 0).mean() < 0.03
    none = lm.build_segment(h[:0], c[:0])
    assert len(none) == 1 and (lm.Filter(np.array([1]), [(0, none)]).counts(other) == 0).all()


@pytest.mark.parametrize("buckets", [16, 1 << 22])
def test_every_ngram_is_learned(llm_spark, monkeypatch, buckets):
    """However little of any fixed size a bucket would get, the scores are those of all counts."""
    monkeypatch.setattr(lm, "SCORED_BYTES", 500, raising=False)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = {i: " ".join(rng.choices(words, k=rng.randint(20, 60))) for i in range(60)}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    df = llm_spark.createDataFrame([(i, t, "x", "y", 1) for i, t in texts.items()], DOCS).repartition(3)
    learned = df.filter(~langid.held_out("doc_id", 7)).select(text_bytes("text").alias("text"))
    scratch = Scratch(llm_spark, "t")
    model, table = lm.train(learned, scratch, buckets=buckets)
    got = {r["doc_id"]: r["score"] for r in lm.score(df, model, table, scratch, {"doc_id": F.col("doc_id")}).collect()}
    rows = {i: [" start", *t.split(), " end"] for i, t in texts.items()}
    one = Counter(w for i, r in rows.items() if not held(i) for w in r)
    two = Counter(x for i, r in rows.items() if not held(i) for x in zip(r, r[1:]))
    about = lambda c: lm.estimates()[lm.level_of(np.array([c]))[0]] if c else 0
    n, v = sum(one.values()) - one[" start"], len(one) - 1
    for i, r in rows.items():
        want = sum(math.log10((min(about(two[a, b]), about(one[a])) + 4 * (about(one[b]) + 1) / (n + v + 1))
                              / (about(one[a]) + 4)) for a, b in zip(r, r[1:]))
        assert got[i] == pytest.approx(want, rel=0.03)


def test_no_training_text(llm_spark):
    rows = [(i, "a b", None, None, 0) for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    _, got = scored(llm_spark, rows)
    assert {(r["train_tokens"], r["n_known"], r["n_tokens"], r["base_score"]) for r in got} == {(0, 0, 3, 0.0)}
    assert scored(llm_spark, [])[1] == []


def test_held_out_text_scores_better_than_the_base(llm_spark):
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    out, scratch = langid.held_out("doc_id", 7), Scratch(llm_spark, "t")
    model, table = lm.train(docs.filter(~out).select(text_bytes("text").alias("text")), scratch)
    r = lm.score(docs, model, table, scratch, {"h": out}).filter("h").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


# ---- personal data ------------------------------------------------------------------

PATTERNS = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"),
            re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def slow_spans(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == 2 and 14 <= len(d) <= 19 and pii.luhn(d) or kind == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), m.end(), kind))
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    for _ in range(5000):
        t = "".join(rng.choice("a1@.2.@ -+()0a.3@4%é") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == slow_spans(t)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_texts_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1.1.1." * 3000, "@" * 50_000, "+1(" * 3000, "[at]" * 3000):
        base, spans = pii.both(t, pii.Field())
        assert len(spans) >= len(base) == (2250 if "." in t else 0)


def test_field_learns_shapes_that_the_patterns_miss(llm_spark):
    docs = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = pii.train(docs)
    added = lambda t: [(pii.KINDS[k], t[a:b]) for a, b, k in pii.both(t, field)[1]]
    assert added("call (415) 555-2671 now") == [("phone", "(415) 555-2671")]
    assert added("his card 4111-1111-1111-1111 is") == [("card", "4111-1111-1111-1111")]
    assert added("+1 (269) 555-3296 4111111111111111 end") == [("phone", "+1 (269) 555-3296"), ("card", "4111111111111111")]
    assert added("order 1234567890123456789012, 9.9. and 3.14") == []
    assert added("plain words") == added("") == []


def test_find_and_redact(llm_spark):
    rows = [(1, "é a.b@c.de 10.0.0.1", None, "s", 0), (2, None, "x", None, 0), (2, "", "x", None, 0),
            (None, "+1 415 555 2671" + " x" * 50_000, None, None, 1)]
    df = llm_spark.createDataFrame(rows, DOCS)
    got = {(r["doc_id"], len(r["spans"])): r for r in pii.find(df, pii.Field()).collect()}
    assert [tuple(s) for s in got[1, 2]["base"]] == [(2, 10, "email"), (11, 19, "ip")]
    assert (2, 0) in got and [tuple(s) for s in got[None, 1]["spans"]] == [(0, 15, "phone")]
    clean = {r["doc_id"]: r for r in pii.redacted(df.limit(2), pii.Field()).collect()}
    assert clean[1]["text"] == "é <email> <ip>" and clean[2]["text"] is None and clean[1]["score"] == "s"
    assert pii.find(df.limit(0), pii.train(df.limit(0))).count() == 0


# ---- languages --------------------------------------------------------------------------

def test_held_out_accuracy(llm_spark):
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out("doc_id")), Scratch(llm_spark, "t"))
    got = langid.predict(docs, model).join(docs, "doc_id").filter(langid.held_out("doc_id"))
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count() > 0
    assert got.agg(F.min("score"), F.max("score")).first()[0] >= 0


def test_language_of_odd_rows(llm_spark):
    rows = [(1, None, "en", "", 0), (2, "", "en", "", 0), (3, "123 !", "en", "", 0), (4, "words here", None, "", 0)]
    df = llm_spark.createDataFrame(rows, DOCS)
    nothing = langid.train(df, Scratch(llm_spark, "t"))
    assert {r["lang_pred"] for r in langid.predict(df, nothing).collect()} == {"und"}
    one = langid.train(llm_spark.createDataFrame([(1, "some text", "xx", "", 0)] * 2, DOCS), Scratch(llm_spark, "t"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(df, one).collect()}
    assert got == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("xx", 1.0)}
    assert [r["doc_id"] for r in langid.kept(df, one).collect()] == [4]
    assert langid.predict(df.limit(0), one).count() == 0
    assert langid.family_of("EN-gb") == langid.family_of("de") != langid.family_of("fr")


def test_learns_from_the_bounded_sample_only(llm_spark):
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs, Scratch(llm_spark, "t"), per_language=5)
    assert model.languages == ["de", "en", "es", "fr"]


# ---- benchmark passages --------------------------------------------------------------------

def slow_found(text, items):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    out = {}
    for item, body in items:
        iw = re.findall(r"[^\W_]+", (body or "").lower())
        k = min(5, len(iw))
        if not iw:
            continue
        ours = Counter(tuple(iw[i:i + k]) for i in range(len(iw) - k + 1))
        for s in range(len(w) - len(iw) + 1):
            theirs = Counter(tuple(w[i:i + k]) for i in range(s, s + len(iw) - k + 1))
            alike = sum((ours & theirs).values()) / sum((ours | theirs).values())
            if alike >= 0.8 and alike > out.get(item, (0, 0))[0]:
                out[item] = (alike, s)
    return out


def test_contamination(llm_spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(80)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(14, 59)))) for i in range(12)]
    items += [(20, "short item"), (21, None), (22, "!!"), (23, items[0][1]), (None, "nothing")]
    texts = [None, "", "short item", "a short item here"]
    for _ in range(60):
        w = rng.choices(vocabulary, k=rng.randint(0, 120))
        body = rng.choice(items[:12])[1].split()
        if rng.random() < 0.6 and len(body) > 30:
            body[rng.choice([0, len(body) - 1, len(body) // 2])] = "changed"
        at = rng.randint(0, len(w))
        texts.append(" ".join([*w[:at], *(x.upper() + "," for x in body), *w[at:]]))
    texts.append("word " * 60_000 + items[3][1])
    rows = [(i, t, "x", "y", 0) for i, t in enumerate(texts)]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    df = llm_spark.createDataFrame(rows, DOCS)
    got = {(r["doc_id"], r["item_id"]): (pytest.approx(r["similarity"]), r["start_word"])
           for r in decontaminate.contaminated(df, bench).collect()}
    want = {(i, item): v for i, t in enumerate(texts[:-1])
            for item, v in slow_found(t, [x for x in items if x[0] is not None]).items()}
    want[len(texts) - 1, 3] = (1.0, 60_000)
    assert got == want and len(want) > 30
    clean = {r["doc_id"] for r in decontaminate.clean(df, bench).collect()}
    assert clean == set(range(len(texts))) - {i for i, _ in want}


def test_contamination_in_passes_and_empty(llm_spark, monkeypatch):
    items = [(i, " ".join(f"a{i}b{j}" for j in range(20))) for i in range(9)]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    df = llm_spark.createDataFrame([(i, "x " + t, "", "", 0) for i, t in items], DOCS)
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", 2)
    got = decontaminate.contaminated(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(9)]
    assert decontaminate.clean(df, bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.clean(df, bench.limit(0)).count() == 9
