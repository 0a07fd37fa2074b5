"""Training samples, cuts and odd rows that a reader of the operators asked about."""

import re

from pyspark.sql import functions as F

from emergent.llm import decontaminate, langid, pii, simhash
from emergent.llm.common import Scratch

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def test_an_address_is_found_however_long(llm_spark):
    field = pii.train(llm_spark.createDataFrame(
        [(i, f"mail bob{i}@example{i}.com, or call +1 555 010 {1000 + i} now, host 10.0.{i}.1") for i in range(200)], "doc_id long, text string"))
    for n in (100, 200, 5000):
        for text in ("x " + "a" * n + " [at] example [dot] com", "x " + "a" * n + " @ example.com",
                     "x b[at]" + "c" * n + " [dot] com y"):
            lo, hi = pii.mails(text)[0]
            assert lo == 2 and text[hi:] in ("", " y")
    df = llm_spark.createDataFrame([(1, "x " + "a" * 200 + " [at] example [dot] com")], "doc_id long, text string")
    assert "aaa" not in pii.redacted(df, field).first()["text"]
    assert pii.mails("@ [at] ( at ) @@ a@ @b.c") == []
    long = "a" * 200_000 + "@" + "b." * 100_000 + "c " + "@" * 1000
    assert pii.mails(long)[0][0] == 0


def test_training_samples_are_bounded_when_ids_repeat(llm_spark):
    rows = [(7, f"call +1 555 010 {i % 9}{1000 + i} or a{i}@b.org", "en") for i in range(3000)]
    rows += [(8, "write to same@host.org", "en")] * 3000 + [(i, f"x{i}@y.org", "fr") for i in range(100, 130)]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    fit, pii.fit = pii.fit, lambda spots: seen.extend(spots)
    try:
        pii.train(df, sample=50)
    finally:
        pii.fit = fit
    assert 0 < len(seen) <= 100
    model = langid.train(df, Scratch(llm_spark, "t"), per_language=40)
    assert sorted(model.languages) == ["en", "fr"]
    sizes = []
    built, langid.Model = langid.Model, lambda x, langs: sizes.extend(langs)
    try:
        langid.train(df, Scratch(llm_spark, "t"), per_language=40)
    finally:
        langid.Model = built
    assert sizes.count("en") <= 40 and sizes.count("fr") == 30


def test_numerals_are_no_letters(llm_spark):
    df = llm_spark.createDataFrame([(i, "the cat sat", "en") for i in range(9)], "doc_id long, text string, lang string")
    model = langid.train(df, Scratch(llm_spark, "t"))
    odd = llm_spark.createDataFrame([(1, "½ ² 12 ٣"), (2, "½ a"), (3, "_")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, model).collect()} == {1: "und", 2: "en", 3: "und"}


def test_items_without_an_id_are_found_and_cleaned(llm_spark, monkeypatch):
    passage = " ".join(WORDS[:12])
    other = " ".join(WORDS[4:18])
    docs = llm_spark.createDataFrame([(1, "see " + passage + " end", 5), (2, "nothing of it here at all", 6), (3, other, 7)],
                                     "doc_id long, text string, item_id int")
    for passes in (20_000, 1):
        monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", passes)
        bench = llm_spark.createDataFrame([(None, passage), (None, other), (None, None), (4, passage)],
                                          "item_id long, text string")
        got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()), key=repr)
        assert got == sorted([(1, None), (1, 4), (3, None)], key=repr)
        assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_windows_are_looked_up_in_pieces(llm_spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(400))
    items = [(i, " ".join(f"w{j}" for j in range(10 * i, 10 * i + 20))) for i in range(30)]
    whole = decontaminate.Items(items).found(text)
    monkeypatch.setattr(decontaminate, "PAIRS_AT_ONCE", 64)
    assert len(whole) == 30 and decontaminate.Items(items).found(text) == whole


def test_a_column_named_like_the_row_number_survives(llm_spark):
    df = llm_spark.createDataFrame([(1, "a b c d", "keep"), (2, "a b c d", "me"), (3, "q r s t u v", None)],
                                   "doc_id long, text string, _key string")
    out = simhash.one_of_each(df)
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d", "keep"), (3, "q r s t u v", None)]
    named = df.withColumnRenamed("text", "_key_").withColumn("_key__", F.lit(1))
    assert simhash.one_of_each(named, text_col="_key").columns == named.columns


def test_base_patterns_are_kept_beside_long_runs():
    text = "." * 50_000 + "@" + "-" * 50_000
    assert pii.base_spans(text) == [] or all(re.search("@", text[a:b]) for a, b, _ in pii.base_spans(text))
