"""Splits, candidate discovery and the registered queries on the smallest data set."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from emergent.operators import discover, split

SF = "/root/testdata/sf0.001"


def test_exact_split_counts(spark):
    rows = [(i, "positive" if i % 3 else "negative") for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "k int, class string").repartition(5)
    out = split.exact_split(df, [F.md5(F.col("k").cast("string")), F.col("k")], test_fraction=0.2)
    counts = {(r["class"], r["split"]): r["n_rows"] for r in split.class_counts(out).collect()}
    n_pos, n_neg = sum(1 for _, c in rows if c == "positive"), sum(1 for _, c in rows if c == "negative")
    assert counts[("positive", "test")] == math.ceil(0.2 * n_pos)
    assert counts[("negative", "test")] == math.ceil(0.2 * n_neg)
    assert out.count() == len(rows)


def test_hash_split_is_layout_independent(spark):
    df = spark.createDataFrame([(str(i),) for i in range(500)], "k string")
    a = split.hash_split(df, F.col("k")).collect()
    b = split.hash_split(df.repartition(9), F.col("k")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_candidates_toy(spark):
    rules = spark.createDataFrame(
        [(["f1"], 10, 0.9, 5.0, 2.0, 0.1), (["f1", "f2"], 10, 0.95, float("inf"), 3.0, 0.1)],
        "antecedent array<string>, label_id int, confidence double, growth_rate double, lift double, support double")
    ents = spark.createDataFrame([(1, "e1", ["f1", "f2"]), (2, "e2", ["f1"]), (3, "e3", ["f3"])],
                                 "entity_id int, entity_name string, features array<string>")
    known = spark.createDataFrame([(2, 10)], "entity_id int, label_id int")
    test = spark.createDataFrame([(1, 10)], "entity_id int, label_id int")
    c = discover.candidates(rules, ents, known, test)
    assert sorted((r.entity_id, tuple(r.antecedent)) for r in c.collect()) == [(1, ("f1",)), (1, ("f1", "f2"))]
    d = discover.dedup_candidates(c).collect()
    assert len(d) == 1 and d[0].antecedent == ["f1"] and d[0].is_hit      # shortest antecedent wins
    s = discover.holdout_summary(discover.dedup_candidates(c)).first()
    assert (s.n_candidates, s.hits, s.novel) == (1, 1, 0)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "entity_id" in df.columns and "is_hit" in df.columns


FAST = ["entity_features", "class_counts", "split_exact", "transactions_pos", "label_rules_m2",
        "growth_rate", "nonredundant_rules", "candidates_dedup", "long_tail", "xml_entity_scan",
        "display_items"]


def _norm(rows):
    return sorted((tuple(repr(v) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_registered_query_matches_oracle(spark, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    con = duckdb.connect()
    for t in ["nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    drows = [tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall()]
    assert _norm(srows) == _norm(drows)


def test_label_bridge_falls_back_to_name(spark):
    from emergent.operators import discover as d
    rows = spark.createDataFrame([("G1", "Flu", "MESH:D1"), ("G2", "COLD", "MESH:D9"), ("G3", "cold", "MESH:D8")],
                                 "bridge_item string, label_name string, label_key string")
    labels = spark.createDataFrame([("D1", "Influenza"), ("D2", "Cold")], "label_id string, label_name string")
    got = sorted((r.label_id, r.bridge_item) for r in
                 d.label_bridge(labels, d.bridge_by_id(rows), d.bridge_by_name(rows)).collect())
    assert got == [("D1", "G1"), ("D2", "G2"), ("D2", "G3")]     # D1 by MESH id, D2 by lower-cased name


def test_sweep_statuses(spark):
    from emergent.operators import sweep, transactions
    assoc = spark.createDataFrame([(e % 5, e % 2) for e in range(200)], "entity_id int, label_id int")
    ents = spark.createDataFrame([(e, [f"F{e}", "F9"]) for e in range(5)], "entity_id int, features array<string>")
    tx = transactions.build_transactions(transactions.pair_counts(assoc), ents)
    known = transactions.pair_counts(assoc)
    res = sweep.run_sweep(tx, ents, tx, known, known, supports=(0.9, 0.01), confidences=(0.1, 0.5),
                          min_growth=0.5)
    rows = {(r.supp_idx, r.conf_idx): r.status for r in res.report.collect()}
    assert rows[(0, 0)] == sweep.NO_RULES and rows[(1, 0)] == sweep.OK
    assert len(rows) == 4                                         # every cell is reported


def test_trap_options(spark):
    from emergent.operators import discover as d, mining, transactions
    from emergent.plans.flow import Flow, Params
    # Q-5: prefer the most confident rule instead of the shortest antecedent.
    rules = spark.createDataFrame(
        [(["f1"], 10, 0.9, 5.0, 2.0, 0.1), (["f1", "f2"], 10, 0.95, 4.0, 3.0, 0.1)],
        "antecedent array<string>, label_id int, confidence double, growth_rate double, lift double, support double")
    ents = spark.createDataFrame([(1, "e1", ["f1", "f2"])], "entity_id int, entity_name string, features array<string>")
    none = spark.createDataFrame([], "entity_id int, label_id int")
    c = d.candidates(rules, ents, none, none)
    assert d.dedup_candidates(c).first().antecedent == ["f1"]
    assert d.dedup_candidates(c, prefer="confidence").first().antecedent == ["f1", "f2"]
    # Q-1: another support denominator for the reported metrics.
    assoc = spark.createDataFrame([(e % 4, e % 2) for e in range(40)], "entity_id int, label_id int")
    feats = spark.createDataFrame([(e, ["a", "b"]) for e in range(4)], "entity_id int, features array<string>")
    tx = transactions.build_transactions(transactions.pair_counts(assoc), feats)
    r = mining.mine_label_rules(tx, 0.1, 0.1, support_base=1000).rules.first()
    assert r.support == r.n_rule / 1000
    # Q-4: with a pair-level split no (entity, label) pair is on both sides.
    f = Flow(spark, SF, Params(split_by_pair=True))
    both = (f.pair_table.filter(F.col("class").isNotNull())
            .groupBy("entity_id", "label_id", "class").agg(F.countDistinct("split").alias("n"))
            .filter(F.col("n") > 1).count())
    assert both == 0


def test_scan_pushdown_and_pruning(spark):
    from emergent.plans.flow import flow
    df = entry.queries()["class_counts"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    li = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln]
    assert li, plan
    assert "In(l_returnflag, [N,R])" in li[0]                      # status filter reaches the scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_returnflag:string>" in li[0]
    assert flow(spark, SF).assoc is not None


@pytest.mark.parametrize("hub_items", [None, 3, 1])
def test_evidence_of_hubs_and_light_entities_equals_brute_force(spark, hub_items):
    import random

    from emergent.operators import discover

    rnd = random.Random(2)
    ents = {e: {f"g{rnd.randrange(60)}" for _ in range(rnd.choice([0, 1, 3, 50]))} for e in range(25)}
    labs = {d: {f"G{rnd.randrange(80)}" for _ in range(rnd.choice([1, 2, 70]))} for d in range(9)}
    pairs = [(e, d) for e in range(26) for d in range(10) if rnd.random() < 0.6]
    eb = spark.createDataFrame([(e, g) for e, s in ents.items() for g in s], "entity_id int, bridge_item string")
    lb = spark.createDataFrame([(d, "GENE_" + g) for d, s in labs.items() for g in s] * 2, "label_id int, bridge_item string")
    cands = spark.createDataFrame(pairs, "entity_id int, label_id int")
    got = discover.evidence(cands, discover.prepare_bridges(eb, lb), hub_items=hub_items).collect()
    assert {(r.entity_id, r.label_id): set(r.bridge) for r in got} == {
        (e, d): {x.upper() for x in ents.get(e, ())} & labs.get(d, set()) for e, d in pairs}
    assert len(got) == len(pairs)


@pytest.mark.parametrize("fraction", [0.0, 0.2, 1 / 3, 1.0])
def test_exact_split_selects_as_a_sort_does(spark, monkeypatch, fraction):
    import hashlib
    import math
    import random

    rnd = random.Random(4)
    keys = [f"k{rnd.randrange(400)}" for _ in range(700)] + ["hot"] * 350      # a third of all rows share one hash
    rows = [(rnd.choice(["a", "b", None]) if k != "hot" else "a", k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "class string, key string, n int").repartition(5)
    out = split.exact_split(df, [F.md5("key"), F.col("n")], test_fraction=fraction)
    assert out.columns == ["class", "key", "n", "split"]
    got = {r.n: r.split for r in out.collect()}
    want = {}
    for c in ("a", "b", None):
        mine = sorted((hashlib.md5(k.encode()).hexdigest(), i) for cl, k, i in rows if cl == c)
        for rank, (_, i) in enumerate(mine):
            want[i] = "test" if rank < math.ceil(fraction * len(mine)) else "train"
    assert got == want
    assert split.exact_split(df.limit(0), [F.md5("key"), F.col("n")]).count() == 0
