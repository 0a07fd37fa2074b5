"""SimHash components and repeated strings against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from emergent.llm import graph, simhash, substrings
from emergent.llm.common import Scratch

DOCS = "doc_id long, text string, fp long, id string, key int"


def slow_fingerprint(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def some_texts(n=120, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "A", "b c"]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(12)]
    out = [None, "", " \t\n", "one", "One two"]
    while len(out) < n:
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("distance,crowd", [(2, 256), (2, 3), (1, 256), (3, 2), (0, 256)])
def test_simhash_components(llm_spark, monkeypatch, distance, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    texts = some_texts()
    rows = [(3 * i + 1, t, 9, "x", 0) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(
        llm_spark.createDataFrame(rows, DOCS).repartition(3), distance=distance).collect()}
    fps = {r[0]: slow_fingerprint(r[1], 3) for r in rows}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    want = components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= distance)
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_simhash_odd_tables(llm_spark):
    empty = llm_spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    rows = [(None, "a b c d", 1, "", 0), (4, "a b c d", 1, "", 0), (4, "a b c d", 1, "", 0)]
    got = simhash.near_duplicates(llm_spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, 4), (4, 4), (4, 4)]
    with pytest.raises(ValueError):
        simhash.near_duplicates(empty, distance=9)


def test_components_of_a_long_path_and_a_hub(llm_spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in graph.connected_components(
        llm_spark.createDataFrame(edges, "u long, v long"), Scratch(llm_spark, "g")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{200 + i: 7 for i in range(50)}, 7: 7}


def slow_removal(rows, length):
    seen, out = set(), {}
    for key, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[key] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowd,at_once,piece", [(4096, 60_000, 1 << 23), (3, 60_000, 1 << 23), (5, 8, 700)])
def test_repeated_strings(llm_spark, monkeypatch, crowd, at_once, piece):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    monkeypatch.setattr(substrings, "AT_ONCE", at_once)
    monkeypatch.setattr(substrings, "PIECE", piece)
    rng = random.Random(5)
    passages = ["".join(rng.choices("abcdé \n", k=rng.randint(60, 400))) for _ in range(6)]
    texts = [None, "", "x" * 99, "y" * 100, "z" * 350, "z" * 200, "ab" * 300, "A" * 10 + "ab" * 90]
    for _ in range(60):
        texts.append("".join(rng.choice(passages)[rng.randint(0, 40):] if rng.random() < 0.5
                             else "".join(rng.choices("pqrs ", k=rng.randint(5, 250))) for _ in range(rng.randint(1, 6))))
    texts += texts[8:20] * 2
    rows = [(7 * i + 2, t, 0, "", i) for i, t in enumerate(texts)]
    df = llm_spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], substrings.digest(bytes(r["kept"])))
           for r in substrings.deduplicated(df, length=100, buckets=8).collect()}
    assert got == slow_removal([(r[0], r[1]) for r in rows], 100)


def test_repeated_strings_odd_tables(llm_spark):
    assert substrings.deduplicated(llm_spark.createDataFrame([], DOCS)).count() == 0
    text = "".join(random.Random(1).choices("abc ", k=300))
    rows = [(None, text, 0, "", 0), (3, text, 0, "", 0), (3, text, 0, "", 0), (4, "short", 0, "", 0)]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in
                 substrings.deduplicated(llm_spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(False, 0, 0), (True, 3, 300), (True, 3, 300), (True, 4, 0)]
    with pytest.raises(ValueError):
        substrings.deduplicated(llm_spark.createDataFrame(rows, DOCS), length=32)
