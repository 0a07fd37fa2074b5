"""Nearest neighbours, packing and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emergent.llm import ann, decontaminate, langid, packing, pii, register, simhash, tokens
from emergent.llm.common import Scratch
from tests.llm.test_records_warc import encoded

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, v int, ids string"


def slow_nearest(rows, k, asked):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v
          and np.isfinite(v).all() and any(v)]
    sizes = [len(v) for _, v in ok]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    ok = [(i, v) for i, v in ok if len(v) == d]
    out = {}
    for i, v in ok:
        if asked(i):
            best = sorted({(-float((v * w).sum()), j) for j, w in ok if j != i})
            out[i] = [j for _, j in best[:k]]
    return out


@pytest.mark.parametrize("d,codes,queries", [(64, 16_384, 1024), (7, 50, 3)])
def test_nearest(llm_spark, monkeypatch, d, codes, queries):
    monkeypatch.setattr(ann, "CODES", codes)
    monkeypatch.setattr(ann, "QUERIES", queries)
    rng = np.random.default_rng(d)
    rows = [(i, (rng.integers(-3, 4, d) if i % 3 else rng.standard_normal(d) + 1).astype(np.float32).tolist())
            for i in range(300)]
    rows += [(300 + i, rows[20][1]) for i in range(60)]  # copies of a query
    rows += [(400, None), (420, [0.0] * d), (440, [float("nan")] * d), (460, [float("inf")] + [1.0] * (d - 1)),
             (480, [None] + [1.0] * (d - 1)), (500, [1.0, 2.0]), (None, [1.0] * d), (40, rows[40][1])]
    df = llm_spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    got = {}
    for r in ann.nearest(df, k=5, is_query=F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = slow_nearest(rows, 5, lambda i: i % 20 == 0)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[i].values()} & set(want[i])) for i in want)
    assert hits >= 0.99 * 5 * len(want)
    assert all(list(sorted(g)) == list(range(1, len(g) + 1)) for g in got.values())
    assert [got[20][k][0] for k in range(1, 6)] == want[20]


def test_blocks_are_numbered_without_moving_them(llm_spark, monkeypatch):
    """The vectors never pass through one task on their way to the queries."""
    plans, searched = [], ann._searched

    def seen(pairs, *more):
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return searched(pairs, *more)

    monkeypatch.setattr(ann, "_searched", seen)
    monkeypatch.setattr(ann, "CODES", 10)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(100)]
    df = llm_spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    got = {}
    for r in ann.nearest(df, k=5, is_query=F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert {i: [v for _, v in sorted(g)] for i, g in got.items()} == slow_nearest(rows, 5, lambda i: i % 20 == 0)
    assert len(plans) == 1 and "Window" not in plans[0] and "SinglePartition" not in plans[0]


def test_nearest_of_few_and_none(llm_spark):
    df = llm_spark.createDataFrame([(20, [1.0, 2.0], 0, ""), (7, [2.0, 1.0], 0, "")], VECTORS)
    got = ann.nearest(df, k=20, is_query=F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(20, 1, 7, 4.0)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_recall_on_the_given_table(llm_spark):
    rows = [(r["vec_id"], r["embedding"]) for r in llm_spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {}
    for r in register.op5_nearest(llm_spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = slow_nearest(rows, 20, lambda i: i % 20 == 0)
    assert sum(len(got[i] & set(want[i])) for i in want) >= 0.9 * sum(map(len, want.values()))


def test_recall_where_the_bound_decides():
    """Far more vectors in a block than are scored first; Gaussian ones have the least clear neighbours."""
    rng = np.random.default_rng(3)
    v = rng.standard_normal((16_384, 64)).astype(np.float32)
    center, turn = v.mean(axis=0).astype(float), ann.rotation(64)
    q = v[:200].astype(float)
    want = [set(np.argsort(-x)[:20]) for x in q @ v.astype(float).T]
    got = ann.search(q, v, *ann.encode(v, center, turn), center, turn, 20)
    hits = sum(len(w & set(at[np.argsort(-score)[:20]])) for w, (at, score) in zip(want, got))
    assert hits >= 0.998 * 20 * len(want)


def check_packed(rows, texts, window):
    ids = {k: encoded(t, 2) for k, t in texts.items()}
    docs, sequences = {}, {}
    for r in rows:
        part = np.frombuffer(bytes(r["ids"]), "<u4")
        assert r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert (part == ids[r["doc_id"]][r["start"]:r["start"] + len(part)]).all()
        docs.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(docs) == set(ids)
    padding = 0
    for parts, want in [(v, len(ids[k])) for k, v in docs.items()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert want is None and at <= window or at == want
        if want is None and at & (at - 1):
            padding += window - at
    return padding


@pytest.mark.parametrize("shard", [1024, 3])
def test_packing(llm_spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_DOCS", shard)
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id % 4 = 0")
    odd = [(10_001, None), (10_002, ""), (10_003, "word " * 20_000), (None, "no id"), (10_004, "copy"), (10_005, "copy")]
    docs = docs.unionByName(llm_spark.createDataFrame(odd, "doc_id long, text string")).withColumn("n", F.lit("x"))
    got = packing.packed(docs, vocabulary=tokens.public_path(), end_id=2, window=512).collect()
    assert check_packed(got, {r["doc_id"]: r["text"] for r in docs.collect()}, 512) == 0
    none = packing.packed(docs.limit(0), vocabulary=tokens.public_path(), end_id=2)
    assert none.count() == 0


def brute_bm25(ids):
    """Score of every document for every document as a query of its distinct ids."""
    n, mean = len(ids), np.mean([len(x) for x in ids])
    vocabulary = sorted({t for x in ids for t in x})
    df = {t: sum(t in set(x) for x in ids) for t in vocabulary}
    counts = [{t: list(x).count(t) for t in set(x)} for x in ids]

    def score(q, d):
        total = 0.0
        for t in set(ids[q]) & set(counts[d]):
            idf = max(0.0, np.log((n - df[t] + 0.5) / (df[t] + 0.5)))
            c = counts[d][t]
            total += idf * c * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(ids[d]) / mean))
        return total

    return [[score(q, d) for d in range(n)] for q in range(n)]


@pytest.mark.parametrize("shard", [8192, 7])
def test_neighbours_of_all_shards(llm_spark, monkeypatch, shard):
    """The lists are those of a search over every document, whatever the shards."""
    monkeypatch.setattr(packing, "SHARD_DOCS", shard)
    docs = (llm_spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
            .select("doc_id", F.substring("text", 1, 600).alias("text")))
    odd = [(60, None), (61, ""), (62, "same words here"), (63, "same words here"), (64, "same words here")]
    docs = docs.unionByName(llm_spark.createDataFrame(odd, "doc_id long, text string")).repartition(3)
    scratch = Scratch(llm_spark, "t")
    table = packing.tokenized(docs, scratch, vocabulary=tokens.public_path(), end_id=2, id_col="doc_id", text_col="text")
    bm25 = packing.Bm25(table)
    rows = table.filter("kind = 0")
    every = rows.withColumn("seed", F.lit(False)).unionByName(rows.filter("id % 2 = 0").withColumn("seed", F.lit(True)))
    blocks = packing.index(every, bm25, scratch, "index")
    id_of = {r["row"]: r["id"] for r in rows.select("row", "id").collect()}
    got = {}
    for r in packing.neighbours(blocks, 10).collect():
        got.setdefault(id_of[r["seed"]], {})[r["rank"]] = (id_of[r["row"]], r["score"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [encoded(texts[i], 2).tolist() for i in range(65)]
    want = brute_bm25(ids)
    assert set(got) == set(range(0, 65, 2))
    for q, found in got.items():
        best = sorted((want[q][d] for d in range(65) if d != q), reverse=True)[:10]
        assert sorted(found) == list(range(1, 11)) and q not in {d for d, _ in found.values()}
        assert len({d for d, _ in found.values()}) == 10
        assert np.allclose([found[k][1] for k in range(1, 11)], best, atol=1e-8)
        assert np.allclose([want[q][found[k][0]] for k in range(1, 11)], best, atol=1e-8)
    assert {d for k in (1, 2) for d, _ in [got[62][k]]} == {63, 64}


def test_seeds_take_their_neighbours(llm_spark):
    """A contested document goes to the seed that ranks it first; a seed that starves gives all back."""
    state = llm_spark.createDataFrame(
        [(1, 0, 3, True), (2, 0, 3, True), (3, 0, 4, False), (4, 5, 4, False), (5, 0, 9, False), (6, 0, 2, True)],
        "row long, start long, left long, seed boolean")
    found = llm_spark.createDataFrame(
        [(1, 3, 9.0, 1), (1, 4, 8.0, 2), (1, 5, 7.0, 3), (2, 4, 9.5, 1), (2, 5, 9.0, 2), (6, 3, 9.5, 2)],
        "seed long, row long, score double, rank int")
    got = {tuple(r) for r in packing.one_pass(state, found, 10).collect()}
    assert got == {(2, 0, 3, 9, 0), (4, 5, 4, 9, 3), (5, 0, 3, 9, 7)}


def test_packing_of_copies(llm_spark):
    """A third of all rows are one text; every copy is placed."""
    docs = llm_spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("one text many times " * 12))
        .otherwise(F.concat(F.lit("word"), F.col("id").cast("string"), F.repeat(F.lit(" other filler"), 30))).alias("text"),
        F.lit(1).alias("row"), F.lit(2).alias("seed"), F.lit("x").alias("sketch"))
    got = packing.packed(docs, vocabulary=tokens.public_path(), end_id=2, window=512)
    rows = got.collect()
    assert check_packed(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, 512) == 0
    assert len({r["sequence_id"] for r in rows}) < 2 * sum(r["length"] for r in rows) / 512 + 40


def test_pipeline_stages(llm_spark):
    import corpus_pipeline as p

    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    scratch, frames = Scratch(llm_spark, "t"), [docs]
    for name, stage in p.STAGES:
        frames.append(scratch.save(stage(llm_spark, frames[-1], SF), name))
    start, spoken, single, clean, masked, packed = frames
    for f in (spoken, single, clean, masked):
        assert f.schema.simpleString() == docs.schema.simpleString()
    rows = lambda f: {r["doc_id"]: r for r in f.collect()}
    model = langid.train(docs.filter(~langid.held_out("doc_id")), Scratch(llm_spark, "t"))
    want = {i for i, r in rows(docs).items() if model.predict(r["text"])[1] >= p.LEAST_LANGUAGE_SCORE}
    assert set(rows(spoken)) == want
    fps = {i: simhash.fingerprint(r["text"].encode()) for i, r in rows(spoken).items()}
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert set(rows(single)) == {i for i in fps if find(i) == i}
    bench = llm_spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r["doc_id"] for r in decontaminate.contaminated(single, bench).collect()}
    assert bad and set(rows(clean)) == set(rows(single)) - bad
    field = pii.train(clean)
    for i, r in rows(masked).items():
        assert r["text"] == pii.masked(rows(clean)[i]["text"], pii.both(rows(clean)[i]["text"], field)[1]) if i < 40 else True
        assert r["n_chars"] == len(r["text"]) or r["n_chars"] is None
    assert check_packed(packed.collect(), {i: r["text"] for i, r in rows(masked).items()}, 4096) == 0


def test_one_row_of_each_component_stays(llm_spark):
    """Null and shared ids: no text goes unless a near copy stays."""
    import corpus_pipeline as p

    rng = np.random.default_rng(6)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60))
    a, b, c, d, e, f, g = (text() for _ in range(7))
    rows = [(None, a), (None, b), (None, b), (5, c), (5, d), (5, d), (None, e), (9, e), (3, e), (3, f), (1, g), (2, f)]
    docs = llm_spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars int")
    got = p.near_duplicates(llm_spark, docs.repartition(3), "")
    assert got.schema.simpleString() == docs.schema.simpleString()
    want = [(None, a), (None, b), (5, c), (5, d), (3, e), (2, f), (1, g)]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == sorted((i or 0, t) for i, t in want)


def test_pipeline_of_nothing(llm_spark):
    import corpus_pipeline as p

    docs = llm_spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(llm_spark, docs, SF)
        assert docs.count() == 0


def test_scratch_is_deleted(llm_spark):
    import os

    s = Scratch(llm_spark, "gone")
    s.save(llm_spark.range(3), "x")
    path = s.root.replace("file:", "")
    assert os.path.isdir(path)
    s.close()
    assert not os.path.exists(path)
