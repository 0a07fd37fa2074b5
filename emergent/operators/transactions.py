"""Transactions and a-priori item pruning.

A transaction is one association row: the entity's features plus exactly one
label.  Rows with equal (entity, label) are identical transactions, so they are
collapsed to one row with a ``multiplicity`` (partial aggregation before the
shuffle); every count downstream sums multiplicities, which keeps duplicate
associations as separate transactions without materialising them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emergent.functions.items import prefixed
from emergent.operators.vertical import item_label_counts
from emergent.session import reliable


def pair_counts(assoc: DataFrame, entity: str = "entity_id", label: str = "label_id") -> DataFrame:
    """Collapse association rows to (entity, label, multiplicity)."""
    return assoc.groupBy(entity, label).agg(F.count(F.lit(1)).alias("multiplicity"))


def build_transactions(pairs: DataFrame, entities: DataFrame, entity: str = "entity_id",
                       label: str = "label_id", features: str = "features") -> DataFrame:
    """P9 + J1 + F4: features of the entity with the label; entities without features drop out."""
    ent = entities.select(entity, features).filter(F.size(features) > 0)
    return pairs.join(ent, entity).select(entity, label, "multiplicity", features)


def total(tx: DataFrame, weight: str = "multiplicity") -> int:
    """Number of transactions (sum of multiplicities); a scalar for the driver."""
    v = tx.agg(F.sum(weight).alias("n")).first()["n"]
    return int(v or 0)


def transaction_items(tx: DataFrame, label: str = "label_id", features: str = "features",
                      label_prefix: str = "LABEL_") -> DataFrame:
    """Mixed item array (features + one label item), sorted and distinct."""
    return tx.withColumn("items", F.array_sort(F.array_distinct(
        F.concat(F.col(features), F.array(prefixed(label_prefix, label))))))


def feature_frequency(tx: DataFrame, features: str = "features", weight: str = "multiplicity") -> DataFrame:
    """A4 for features: (item, frequency)."""
    return (tx.select(F.explode(features).alias("item"), weight)
            .groupBy("item").agg(F.sum(weight).alias("frequency")))


def label_frequency(tx: DataFrame, label: str = "label_id", weight: str = "multiplicity") -> DataFrame:
    """A4 for labels: (label, frequency)."""
    return tx.groupBy(label).agg(F.sum(weight).alias("frequency"))


def item_frequency(tx: DataFrame, label: str = "label_id", features: str = "features",
                   weight: str = "multiplicity", label_prefix: str = "LABEL_") -> DataFrame:
    """A4: frequency of every item, label items included (as ``LABEL_<id>``)."""
    labs = label_frequency(tx, label, weight).select(prefixed(label_prefix, label).alias("item"), "frequency")
    return feature_frequency(tx, features, weight).unionByName(labs)


@dataclass
class Pruned:
    """T3 result: pruned transactions plus the counts the source reports."""

    tx: DataFrame
    n_before: int
    threshold: float
    frequent_features: DataFrame
    frequent_labels: DataFrame
    item_counts: DataFrame          # (item, label, n) of the transactions before pruning
    changed: bool = True            # False when nothing was infrequent (tx returned as is)


def prune_transactions(tx: DataFrame, entities: DataFrame, min_support: float,
                       n_total: int | None = None, entity: str = "entity_id",
                       label: str = "label_id", features: str = "features") -> Pruned:
    """F8 + J4 + F5.

    An item (feature or label) is frequent when its count is at least
    ``min_support * N`` over all transactions.  Infrequent features are removed
    from the entity feature lists (a per-entity regroup, bounded by the entity's
    own features); a transaction survives when its label is frequent and at
    least one feature is left (>= 2 items with the label).
    """
    n = total(tx) if n_total is None else n_total
    thr = float(min_support) * n
    ones = item_label_counts(tx, label, features, "multiplicity")
    fq = ones.groupBy("item").agg(F.sum("n").alias("frequency"))
    lq = reliable(label_frequency(tx, label), "label-frequency")
    ff = fq.filter(F.col("frequency") >= F.lit(thr))
    lf = lq.filter(F.col("frequency") >= F.lit(thr))
    infrequent = (fq.filter(F.col("frequency") < F.lit(thr)).select(F.lit(1).alias("_x"))
                  .unionByName(lq.filter(F.col("frequency") < F.lit(thr)).select(F.lit(1).alias("_x")))
                  .limit(1).count())
    if infrequent == 0:
        # Nothing to drop: every transaction keeps all its items (>= 1 feature plus its label).
        return Pruned(tx.select(entity, label, "multiplicity", features), n, thr, ff, lf, ones, changed=False)
    kept = (entities.select(entity, F.explode(features).alias("item"))
            .join(ff.select("item"), "item", "left_semi")
            .groupBy(entity).agg(F.array_sort(F.collect_list("item")).alias(features)))
    out = (tx.select(entity, label, "multiplicity")
           .join(lf.select(label), label, "left_semi")
           .join(kept, entity)
           .select(entity, label, "multiplicity", features))
    return Pruned(out, n, thr, ff, lf, ones)


def vocabulary_stats(tx: DataFrame, pruned: Pruned, label: str = "label_id",
                     features: str = "features", weight: str = "multiplicity") -> DataFrame:
    """A5: vocabulary and transaction counts before and after pruning, as one lazy row."""
    def one(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("v")).select(F.lit(name).alias("k"), "v")

    rows = F.count(F.lit(1))
    parts = (one(item_frequency(tx, label, features), "items_before", rows)
             .unionByName(one(pruned.frequent_features, "items_after", rows))
             .unionByName(one(pruned.frequent_labels, "items_after", rows))
             .unionByName(one(tx, "tx_before", F.sum(weight)))
             .unionByName(one(pruned.tx, "tx_after", F.sum(weight))))
    return parts.agg(*(F.sum(F.when(F.col("k") == name, F.col("v"))).alias(name)
                       for name in ("items_before", "items_after", "tx_before", "tx_after")))


#: log2 of a vocabulary sketch's registers, and the relative error that its estimates stay within (over five
#: standard errors of such a sketch).
SKETCH_BITS, SKETCH_BAND = 14, 0.04


def vocabulary_sketches(tx: DataFrame, by: Sequence[str], label: str = "label_id", features: str = "features",
                        label_prefix: str = "LABEL_", bits: int = SKETCH_BITS) -> DataFrame:
    """A5 at scale: ``(by..., sketch)``, a mergeable sketch of the distinct items per group of transactions.

    One row of at most ``2 ** bits`` bytes a group, combined map side: no item is
    shuffled.  Store it, and ``merged_vocabulary`` answers any union of groups.
    """
    item = F.explode(F.concat(F.col(features), F.array(prefixed(label_prefix, label)))).alias("_item")
    return tx.select(*by, item).groupBy(*by).agg(F.hll_sketch_agg("_item", bits).alias("sketch"))


def merged_vocabulary(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., items)``: the estimated number of distinct items of the union of each group's sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("items"))
