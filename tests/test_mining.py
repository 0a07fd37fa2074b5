"""Miner M2 against brute-force counting, against MLlib (M1), and invariance checks."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emergent.operators import mining, transactions


def random_tx(seed, n_entities=40, n_labels=4, n_rows=300, vocab=9):
    rnd = random.Random(seed)
    feats = {e: sorted(rnd.sample([f"F{i}" for i in range(vocab)], rnd.randint(1, 5))) for e in range(n_entities)}
    rows = [(rnd.randrange(n_entities), rnd.randrange(n_labels)) for _ in range(n_rows)]
    return feats, rows


def brute_rules(feats, rows, min_support, min_conf, max_ante=99):
    tx = [(frozenset(feats[e]), lab) for e, lab in rows]
    n = len(tx)
    mc = math.ceil(min_support * n)
    n_label = Counter(lab for _, lab in tx)
    cnt, ante = Counter(), Counter()
    for items, lab in tx:
        for k in range(1, min(max_ante, len(items)) + 1):
            for s in itertools.combinations(sorted(items), k):
                cnt[(s, lab)] += 1
                ante[s] += 1
    out = {}
    for (s, lab), c in cnt.items():
        if c >= mc and c / ante[s] >= min_conf:
            out[(s, lab)] = (c, ante[s], n_label[lab])
    return out


def to_frames(spark, feats, rows):
    assoc = spark.createDataFrame(rows, "entity_id int, label_id int")
    ents = spark.createDataFrame([(e, f) for e, f in feats.items()], "entity_id int, features array<string>")
    return transactions.build_transactions(transactions.pair_counts(assoc), ents)


@pytest.mark.parametrize("seed", [1, 2])
def test_m2_equals_brute_force(spark, seed):
    feats, rows = random_tx(seed)
    tx = to_frames(spark, feats, rows)
    mined = mining.mine_label_rules(tx, 0.02, 0.1)
    got = {(tuple(r.antecedent), r.label_id): (r.n_rule, r.n_ante, r.n_label) for r in mined.rules.collect()}
    want = brute_rules(feats, rows, 0.02, 0.1)
    assert got == want
    for r in mined.rules.collect():
        assert r.support == r.n_rule / len(rows)
        assert r.confidence == r.n_rule / r.n_ante


def test_m1_equals_m2(spark):
    feats, rows = random_tx(7)
    tx = to_frames(spark, feats, rows)
    m2 = {(tuple(r.antecedent), r.label_id): (r.support, r.confidence, r.lift)
          for r in mining.mine_label_rules(tx, 0.02, 0.1).rules.collect()}
    _, rules = mining.mine_fpgrowth(tx, 0.02, 0.1)
    m1 = {(tuple(r.antecedent), r.label_id): (r.support, r.confidence, r.lift) for r in rules.collect()}
    assert m1 == m2


def test_partitioning_does_not_change_rules(spark):
    feats, rows = random_tx(3)
    tx = to_frames(spark, feats, rows)
    a = mining.mine_label_rules(tx, 0.02, 0.1).rules
    b = mining.mine_label_rules(tx.repartition(7, "label_id"), 0.02, 0.1).rules
    cols = ["antecedent", "label_id", "n_rule", "n_ante", "support", "confidence", "lift"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_pruning_counts(spark):
    feats, rows = random_tx(5)
    tx = to_frames(spark, feats, rows)
    ents = spark.createDataFrame([(e, f) for e, f in feats.items()], "entity_id int, features array<string>")
    p = transactions.prune_transactions(tx, ents, 0.3)
    thr = 0.3 * len(rows)
    item_cnt = Counter(i for e, _ in rows for i in feats[e])
    lab_cnt = Counter(lab for _, lab in rows)
    keep = {i for i, c in item_cnt.items() if c >= thr}
    keep_lab = {lab for lab, c in lab_cnt.items() if c >= thr}
    expected = sum(1 for e, lab in rows if lab in keep_lab and set(feats[e]) & keep)
    assert transactions.total(p.tx) == expected
    for r in p.tx.collect():
        assert set(r.features) <= keep and r.label_id in keep_lab


def test_status_values(spark):
    feats, rows = random_tx(9)
    tx = to_frames(spark, feats, rows)
    assert mining.mine_label_rules(tx.filter(F.lit(False)), 0.1, 0.1).status == mining.EMPTY
    assert mining.mine_label_rules(tx, 0.99, 0.1).status == mining.NO_RULES


def test_hot_pair_holding_a_third_of_rows(spark):
    # One (entity, label) pair carries a third of all association rows: the
    # collapsed miner must count it with its full multiplicity, and the MLlib
    # input expansion must produce every row (in bounded chunks).
    feats, rows = random_tx(12, n_rows=200)
    rows = rows + [(0, 1)] * 100
    tx = to_frames(spark, feats, rows)
    got = {(tuple(r.antecedent), r.label_id): (r.n_rule, r.n_ante, r.n_label)
           for r in mining.mine_label_rules(tx, 0.02, 0.1).rules.collect()}
    assert got == brute_rules(feats, rows, 0.02, 0.1)
    big = spark.createDataFrame([(1, ["a", "b"], 10_000)], "label_id int, features array<string>, multiplicity long")
    exp = mining.expand_transactions(big)
    assert exp.count() == 10_000
    assert exp.distinct().first()["items"] == ["LABEL_1", "a", "b"]


def test_restrict_support_equals_direct_mining(spark):
    feats, rows = random_tx(21, n_rows=400)
    tx = to_frames(spark, feats, rows)
    cols = ["antecedent", "label_id", "n_rule", "n_ante", "n_label", "support", "confidence", "lift"]
    direct = mining.mine_label_rules(tx, 0.05, 0.1)
    derived = mining.restrict_support(mining.mine_label_rules(tx, 0.02, 0.1), 0.05)
    assert derived.status == direct.status and derived.n_itemsets == direct.n_itemsets
    assert sorted(map(tuple, derived.rules.select(cols).collect())) == sorted(map(tuple, direct.rules.select(cols).collect()))


@pytest.mark.parametrize("rows_a_block,pairs,support", [(8192, 2_000_000, 0.01), (64, 5, 0.01), (128, 40, 0.03)])
def test_bitmaps_equal_brute_force_whatever_the_blocks_and_passes(spark, monkeypatch, rows_a_block, pairs, support):
    from emergent.operators import vertical

    monkeypatch.setattr(vertical, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(vertical, "PAIRS_A_PASS", pairs)
    feats, rows = random_tx(31, n_labels=7, n_rows=500, vocab=12)
    rows += [(0, 1)] * 300 + [(3, 99)]          # multiplicities over several planes, a label below every threshold
    tx = to_frames(spark, feats, rows).repartition(3)
    got = {(tuple(r.antecedent), r.label_id): (r.n_rule, r.n_ante, r.n_label)
           for r in mining.mine_label_rules(tx, support, 0.1).rules.collect()}
    assert got == brute_rules(feats, rows, support, 0.1)
    short = mining.mine_label_rules(tx, support, 0.1, max_antecedent=2).rules
    assert short.agg(F.max("length")).first()[0] <= 2
    assert short.count() == sum(len(k[0]) <= 2 for k in got)


def test_items_that_never_meet_and_text_labels(spark):
    rows = [("x", ["a", "é"], 3), ("y", ["b"], 4), ("y", ["a", "b"], 1), ("é", ["c"], 2), (None, ["a"], 9)]
    tx = spark.createDataFrame(rows, "label_id string, features array<string>, multiplicity long").filter("label_id is not null")
    got = {(tuple(r.antecedent), r.label_id): (r.n_rule, r.n_ante, r.n_label)
           for r in mining.mine_label_rules(tx, 0.1, 0.0).rules.collect()}
    assert got == {(("a",), "x"): (3, 4, 3), (("é",), "x"): (3, 3, 3), (("a", "é"), "x"): (3, 3, 3), (("a",), "y"): (1, 4, 5),
                   (("b",), "y"): (5, 5, 5), (("a", "b"), "y"): (1, 1, 5), (("c",), "é"): (2, 2, 2)}


def test_vocabulary_sketches_merge_within_their_band(spark):
    tx = (spark.range(60_000).select((F.col("id") % 3).alias("part"), (F.col("id") % 7).cast("int").alias("label_id"),
                                     F.array(F.concat(F.lit("a"), F.col("id")), F.concat(F.lit("b"), F.col("id") % 20_000)).alias("features")))
    stored = transactions.vocabulary_sketches(tx, ["part"])
    assert stored.count() == 3
    union = transactions.merged_vocabulary(stored).first()["items"]
    exact = 60_000 + 20_000 + 7
    assert 0 < abs(union - exact) <= transactions.SKETCH_BAND * exact
    parts = {r.part: r.items for r in transactions.merged_vocabulary(stored, ["part"]).collect()}
    for p, n in parts.items():
        want = tx.filter(F.col("part") == p).select(F.explode("features")).distinct().count() + 7
        assert abs(n - want) <= transactions.SKETCH_BAND * want
    assert transactions.merged_vocabulary(stored.limit(0)).first()["items"] in (None, 0)
