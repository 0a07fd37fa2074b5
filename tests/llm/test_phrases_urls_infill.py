"""Phrases, url rules and fill-in-middle against brute force, with odd rows and hot groups."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emergent.llm import infill, phrases, urlrules

DOCS = "doc_id long, text string, lang string, n long, f long, form string, word string"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def slow_phrases(rows, longest, least, scale, percent, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    many = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    holder = Counter()
    for (lang, w), a in many.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                holder[lang, w[i:i + k]] = max(holder[lang, w[i:i + k]], a)
    out = {}
    for (lang, w), a in many.items():
        if 100 * holder[lang, w] >= percent * a and holder[lang, w]:
            continue
        cuts = [(scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, rank + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def phrase_rows(n=150, seed=3):
    rng = random.Random(seed)
    common = ["of", "The", "é", "a", "in", "x" * 50]
    passage = "once upon a time there was a hot passage that many share"
    rows = [(None, "en"), ("", None), (" \t\n.,", "en"), ("no language here no language here", None)]
    for _ in range(n):
        w = rng.choices(common + [f"w{rng.randint(0, 40)}" for _ in range(4)], k=rng.randint(1, 60))
        text = " ".join(x + rng.choice(["", "", "", ",", "\n", "\t"]) for x in w)
        rows.append((text + (" " + passage if rng.random() < 0.4 else ""), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("hot,bits,longest", [(1 / 4096, 27, 4), (2.0, 15, 4), (1 / 50, 16, 3)])
def test_phrases(llm_spark, monkeypatch, hot, bits, longest):
    monkeypatch.setattr(phrases, "HOT_SHARE", hot)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = phrase_rows()
    df = llm_spark.createDataFrame([(1, t, l, 0, 0, "", "") for t, l in rows], DOCS).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, longest=longest, least=5, top=40).collect())
    assert len(got) > 50 and got == slow_phrases(rows, longest, 5, 2_000_000, 80, 40)


def test_phrases_of_one_third_hot_words_and_large_numbers(llm_spark):
    rows = [("of the " * 400, "en")] * 20 + phrase_rows(60, 8)
    df = llm_spark.createDataFrame([(None, t, l, 0, 0, "", "") for t, l in rows], DOCS).repartition(4)
    scale = 10 ** 17  # products beyond 64 bits
    got = sorted(tuple(r) for r in phrases.collocations(df, least=10, scale=scale, top=10 ** 6).collect())
    assert got == slow_phrases(rows, 4, 10, scale, 80, 10 ** 6)


def test_phrases_odd_tables(llm_spark):
    empty = llm_spark.createDataFrame([], DOCS)
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(llm_spark.createDataFrame([(1, None, None, 0, 0, "", "")], DOCS)).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(empty, longest=1)


def test_filter_hashes_agree_with_spark(llm_spark):
    block = phrases._Numbered("en", "Ünï word, other".encode())
    got = llm_spark.createDataFrame([("en", bytearray(w)) for w in block.words[1:]], "lang string, word binary") \
        .select(F.xxhash64("lang", "word").alias("h")).collect()
    assert [r["h"] for r in got] == block.hash[1:].view(np.int64).tolist()


def test_quicksort_counts_equal_partitions():
    rng = random.Random(4)
    suffixes = [[rng.randint(1, 4) for _ in range(rng.randint(1, 4))] for _ in range(400)]
    at = [x for s in suffixes for x in (*s, 0)]
    starts = np.cumsum([0] + [len(s) + 1 for s in suffixes[:-1]])
    weights = np.array([rng.randint(1, 5) for _ in suffixes])
    got = {tuple(at[p:p + d]): n for p, d, n in
           phrases.equal_partitions(np.array(at), starts, weights, 0, 3, 12)}
    want = Counter()
    for s, w in zip(suffixes, weights):
        for d in range(1, min(3, len(s)) + 1):
            want[tuple(s[:d])] += int(w)
    assert got == {k: v for k, v in want.items() if v >= 12}


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "http://example.org/en/1", "x://org", "x://org/",
        "http://example.org/en/12/", "http://notexample.org/es/", "http://org./", "http://u@b.com:80/fr/", "ftp://b.com/de/",
        "http://c.com/fr", "http://a.com#/fr/", "http://a.com?x=/fr/", "a://b://c.com/fr/", "http://É.com/dé/", "x:///es/",
        "http://" + "a." * 5000 + "com/de/" + "p" * 100_000, "http://example.org/es/\nline"]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("", "/es/", "block"), ("é.com", "/dé", "block"), ("com", "/de/", "allow")]


def slow_verdict(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h.split(".")), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_url_rules(llm_spark, broadcast):
    rules = [(lower(h), p, v) for h, p, v in RULES]
    rng = random.Random(6)
    urls = URLS + [f"http://{rng.choice(['', 'a.', 'www.b.'])}{rng.choice(['example.org', 'com', 'x.com', 'net'])}"
                   f"/{rng.choice(['es', 'en', 'fr', 'de'])}{rng.choice(['', '/', '/1', '/12?q'])}" for _ in range(80)]
    rows = [(i if i % 5 else None, u, "x", "y") for i, u in enumerate(urls)] + [(7, URLS[5], "x", "y")] * 60
    df = llm_spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(3)
    old = llm_spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm_spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = [tuple(r) for r in urlrules.judged(df, llm_spark.createDataFrame(
            RULES + [(None, None, "allow")], "host string, path string, verdict string")).collect()]
    finally:
        llm_spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = [(r[0], *slow_verdict(r[1], rules + [("", "", "allow")])) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_url_rules_prefix_collisions_are_confirmed(llm_spark, monkeypatch):
    monkeypatch.setattr(urlrules, "_prefix", lambda digest: F.lit(7).cast("long"))  # every prefix collides
    df = llm_spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    rules = llm_spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in urlrules.judged(df, rules).select("page_id", "verdict").collect())
    assert got == [(i, slow_verdict(u, [(lower(h), p, v) for h, p, v in RULES])[3]) for i, u in enumerate(URLS)]


def test_url_rules_odd_tables(llm_spark):
    pages = llm_spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id long, url string")
    rules = "host string, path string, verdict string"
    none = llm_spark.createDataFrame([], rules)
    assert sorted(tuple(r) for r in urlrules.judged(pages, none, default="block").collect()) == [
        (1, "a.org", "/", None, "block"), (2, "", "", None, "block")]
    assert urlrules.judged(pages.limit(0), llm_spark.createDataFrame(RULES, rules)).count() == 0
    with pytest.raises(Exception, match="allow or block"):
        urlrules.judged(pages, llm_spark.createDataFrame([("a", "/", None)], rules)).collect()


def slow_infill(doc_id, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def infill_texts():
    rng = random.Random(2)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\n", "x <P> y\nz", "<M>", "<\n<P", "P>\n<S\nS>", "\r\n\x0b\u2028é\n𝄞\n", "\x00\n<"]
    texts += ["\n" * 3000, "l" * 3_000_000 + "\nend\n" * 5, "𝄞é\n" * 400_000]
    for _ in range(150):
        texts.append("".join("w" * int(rng.paretovariate(0.6) % 4000) + rng.choice(["\n", "\n", "<", "é\n"])
                             for _ in range(rng.randint(1, 300))))
    return texts


@pytest.mark.parametrize("fim,spm,bound", [(100, 50, 127), (60, 20, 1)])
def test_infill_round_trip(llm_spark, monkeypatch, fim, spm, bound):
    texts = infill_texts()
    rows = [(i if i != 4 else None, t, "keep", 9, "old", "z", "z") for i, t in enumerate(texts)] + [(9999, "same\nid\n", "", 1, "", "", "")] * 3
    df = llm_spark.createDataFrame(rows, DOCS.replace("f long", "output string")).repartition(3)
    out = infill.transformed(df, fim_percent=fim, spm_percent=spm, bound=bound)
    assert out.columns == ["doc_id", "text", "lang", "word", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("back", infill.restored("form", "output")).collect()
    key = lambda x: (x[0] is not None, x[0] or 0)
    want = sorted(((r[0], *slow_infill(r[0], r[1], fim=fim, spm=spm), r[1] or "", r[2]) for r in rows), key=key)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"], r["lang"])
                   for r in got), key=key) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_infill_odd_tables(llm_spark):
    empty = llm_spark.createDataFrame([], "doc_id long, text string")
    assert infill.transformed(empty).count() == 0
    named = llm_spark.createDataFrame([(3, "a\nb\n", 1)], "n long, output string, _fim0 int")
    row = infill.transformed(named, "n", "output").first()
    assert (row["n"], row["_fim0"]) == (2, 1) and row["form"] != "plain"
    with pytest.raises(ValueError):
        infill.transformed(empty, markers=("aba", "c", "d"))


@pytest.mark.parametrize("bound", [1, 5, 127])
def test_rank_index_is_exact_and_bounded(bound):
    rng = np.random.default_rng(1)
    for size in (1, 2, 17, 5000):
        for steps in (rng.integers(1, 3, size), rng.integers(1, 2000, size), (rng.pareto(0.5, size) * 10 + 1).astype(np.int64) % 10 ** 8 + 1,
                      np.full(size, 80)):
            offsets = np.append(0, np.cumsum(steps))
            index = infill.RankIndex.fit(offsets, bound)
            assert np.array_equal(index.offsets(np.arange(size + 1)), offsets)
            assert np.abs(offsets - index.predict(np.arange(size + 1))).max() <= bound
    assert len(infill.RankIndex.fit(np.arange(0, 80 * 5001, 80), bound).first) == 1
