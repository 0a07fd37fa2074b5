"""Findings on growth: what a query keeps in memory, shuffles, sends to the driver or leaves to one task."""

import itertools
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emergent.operators import mining, vertical
from emergent.operators.containment import containment_join
from emergent.plans import register
from emergent.plans.flow import Flow, Params
from emergent.sources import standin

SF_SMOKE = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above(plan: str, leaf: str) -> list[str]:
    """The nodes between a plan's root and the first line that holds ``leaf``."""
    def depth(line: str) -> int:
        return next((i for i, c in enumerate(line) if c.isalpha() or c == "*"), 0)

    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    out, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            out.append(line)
            least = depth(line)
    return out


def test_label_rules_m1_come_from_written_itemsets(spark):
    tx = spark.createDataFrame([(1, 1, ["a", "b"], 3), (2, 2, ["a"], 2)],
                               "entity_id int, label_id int, features array<string>, multiplicity long")
    _, rules = mining.mine_fpgrowth(tx, 0.1, 0.1)
    assert "ExistingRDD" not in plan_of(rules)
    got = {(tuple(r.antecedent), r.label_id): (r.support, r.confidence, r.lift) for r in rules.collect()}
    assert got == {(("a",), 1): (0.6, 0.6, 1.0), (("b",), 1): (0.6, 1.0, 1 / 0.6), (("a", "b"), 1): (0.6, 1.0, 1 / 0.6),
                   (("a",), 2): (0.4, 0.4, 1.0)}


def counted(n_blocks: int):
    items, labels = [f"i{i:02d}" for i in range(60)], list(range(24))
    rows = pa.table({"label": pa.array([i % 24 for i in range(96)], pa.int32()), "features": pa.array([items] * 96),
                     "weight": pa.array([1] * 96, pa.int64())})
    block = next(vertical._block_builder(items, labels, 8192)(iter(rows.to_batches())))
    masks = np.full((60, 3), 255, np.uint8)
    shared = SimpleNamespace(value=[((), np.arange(60), masks, 0, 59)])
    run = vertical._candidate_counter(shared, items, len(labels), 2)
    tracemalloc.start()
    out = pa.Table.from_batches(list(run(iter([block] * n_blocks))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


def test_counting_keeps_no_more_for_more_blocks():
    out, peak = counted(60)
    assert out.num_rows == 1770 * 24 and set(out.column("n").to_pylist()) == {60 * 4}
    assert peak < 20_000_000


def test_counting_without_one_array_is_bounded_too(monkeypatch):
    whole = counted(8)[0].to_pylist()
    monkeypatch.setattr(vertical, "DENSE_COUNTS", 0)
    monkeypatch.setattr(vertical, "HELD_COUNTS", 5000)
    total: dict = {}
    for r in counted(8)[0].to_pylist():
        key = (tuple(r["antecedent"]), r["label"])
        total[key] = total.get(key, 0) + r["n"]
    assert total == {(tuple(r["antecedent"]), r["label"]): r["n"] for r in whole}


def test_best_cell_without_rules_mines_nothing_more(spark):
    f = Flow(spark, SF_SMOKE, Params(sweep_supports=(0.9,), sweep_confidences=(0.9,)))
    tables = f.best_results
    assert "mined" not in vars(f) and tables["rules"].count() == 0 and tables["candidates"].count() == 0


def test_lineitems_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = above(plan_of(standin.associations(spark, SF_SMOKE)), "FileScan parquet [l_orderkey")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Exchange" in n for n in nodes) == 1


def test_entities_are_read_from_the_part_table_once(spark):
    f = Flow(spark, SF_SMOKE)
    assert "part.parquet" not in " ".join(f.entities.inputFiles())
    assert "Exchange" in plan_of(standin.entities(spark, SF_SMOKE))


def test_item_lists_are_not_broadcast(spark):
    sets = spark.createDataFrame([(["a"],)], "s array<string>")
    targets = spark.createDataFrame([(1, ["a", "b"])], "id int, items array<string>")
    joined = containment_join(sets, "s", targets, "items", target_key=["id"])
    assert next(x for x in plan_of(joined).splitlines() if "Join" in x).count("SortMergeJoin") == 1
    assert [tuple(r) for r in joined.select("id", "s").collect()] == [(1, ["a"])]


def test_parts_of_one_key_keep_their_order_over_many_tasks(spark):
    part = spark.createDataFrame([(i % 7, i) for i in range(100)], "p_partkey long, n int").coalesce(1)
    dealt = register.in_place_order(part)
    assert "rangepartitioning" in plan_of(dealt)
    seen: dict = {}
    for r in dealt.collect():
        seen.setdefault(r.p_partkey, []).append(r.n)
    assert all(v == sorted(v) for v in seen.values()) and sum(map(len, seen.values())) == 100


def test_transactions_stand_in_the_order_of_the_trees_paths(spark):
    """Equal ones of all entities are counted first; a hot one is dealt over tasks; no row is lost."""
    rows = [(i, i % 2, ["a", "b"] if i % 3 else ["b", "c"], 1 + i % 4) for i in range(60)] + [(99, 7, ["a", "z"], 60_000)]
    tx = spark.createDataFrame(rows, "entity_id int, label_id int, features array<string>, multiplicity long").repartition(7)
    out = mining.expand_transactions(tx).select("items", F.spark_partition_id().alias("task"))
    got = [(r.task, tuple(r["items"])) for r in out.collect()]
    want: dict = {}
    for _, label, features, n in rows:
        key = tuple(sorted([*features, f"LABEL_{label}"]))
        want[key] = want.get(key, 0) + n
    assert {k: sum(x == k for _, x in got) for k in want} == want and len(got) == sum(want.values())
    frequency: dict = {}
    for key, n in want.items():
        for item in key:
            frequency[item] = frequency.get(item, 0) + n
    path = {key: sorted(key, key=lambda x: (-frequency[x], x)) for key in want}
    # Paths that begin alike are neighbours, so they follow one another without a return.
    assert [k for k, _ in itertools.groupby(x for _, x in sorted(got, key=lambda r: r[0]))] == sorted(want, key=path.get)
    tasks = {k: {t for t, x in got if x == k} for k in want}
    hot = ("LABEL_7", "a", "z")
    assert len(tasks[hot]) > 1 and max(sum(r == (t, hot) for r in got) for t in tasks[hot]) < 60_000
    assert all(len(t) == 1 for k, t in tasks.items() if k != hot)


def test_items_may_be_missing(spark):
    schema = "entity_id int, label_id int, features array<string>, multiplicity long"
    assert mining.expand_transactions(spark.createDataFrame([], schema)).count() == 0
    tx = spark.createDataFrame([(1, 1, ["a"], 2), (2, None, ["a"], 3), (3, 1, None, 4)], schema)
    got = [r["items"] for r in mining.expand_transactions(tx).collect()]
    assert got.count(["LABEL_1", "a"]) == 2 and got.count(["a", None]) == 3 and got.count(None) == 4 and len(got) == 9
