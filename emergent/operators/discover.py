"""Candidate discovery from rules.

A candidate is an (entity, label) pair whose entity's features contain a
rule's antecedent (containment join keyed by the rarest antecedent item) and
which is not a known positive training pair.  All pair-level joins and the
de-duplication share the (entity, label) key, so one hash partitioning serves
them.  De-duplication is an aggregate (``min`` of an ordered struct), combined
map side, instead of a window over every candidate row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.functions.items import INDIRECT, mesh_id, restrict_prefix, sorted_text, strip_prefix_upper
from emergent.operators.containment import containment_join
from emergent.session import reliable

ENTITY = "entity_id"
LABEL = "label_id"


def label_names(assoc: DataFrame, bridge_rows: DataFrame | None = None, label: str = LABEL) -> DataFrame:
    """A3 + J2: name of every label: association name, else bridge-table name by ``MESH:`` id, else the id.

    Of several names the greatest is taken, or the last one where the rows have a ``place``.
    """
    name = F.max("label_name")
    if "place" in assoc.columns:
        name = F.max_by("label_name", F.when(F.col("label_name").isNotNull(), F.col("place")))
    names = assoc.groupBy(label).agg(name.alias("_an"))
    if bridge_rows is not None:
        bn = bridge_rows.groupBy("label_key").agg(F.max("label_name").alias("_bn"))
        names = names.join(bn, mesh_id(label) == F.col("label_key"), "left").drop("label_key")
    else:
        names = names.withColumn("_bn", F.lit(None).cast("string"))
    return names.select(label, F.coalesce("_an", "_bn", F.col(label).cast("string")).alias("label_name"))


def bridge_by_id(bridge_rows: DataFrame) -> DataFrame:
    """A1 (long form): distinct (label_key, bridge_item)."""
    return bridge_rows.select("label_key", "bridge_item").distinct()


def bridge_by_name(bridge_rows: DataFrame) -> DataFrame:
    """A2 (long form): distinct (lower-cased name, bridge_item); names differing in case merge."""
    return (bridge_rows.filter(F.col("label_name").isNotNull())
            .select(F.lower("label_name").alias("name_key"), "bridge_item").distinct())


def label_bridge(labels: DataFrame, by_id: DataFrame, by_name: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, bridge_item) via the ``MESH:`` id when it has any entry, else via the lower-cased name."""
    lab = labels.select(label, "label_name").distinct().withColumn("_idk", mesh_id(label)).withColumn(
        "_nk", F.lower("label_name"))
    has_id = by_id.select(F.col("label_key").alias("_idk")).distinct().withColumn("_has_id", F.lit(True))
    lab = lab.join(has_id, "_idk", "left")
    via_id = (lab.filter(F.col("_has_id").isNotNull())
              .join(by_id, F.col("_idk") == F.col("label_key")).select(label, "bridge_item"))
    via_name = (lab.filter(F.col("_has_id").isNull())
                .join(by_name, F.col("_nk") == F.col("name_key")).select(label, "bridge_item"))
    return via_id.unionByName(via_name)


def rule_matches(rules: DataFrame, entities: DataFrame, prefixes: Sequence[str] | None = None,
                 entity: str = ENTITY, label: str = LABEL) -> DataFrame:
    """Every rule with every entity whose features contain its antecedent, on ids alone.

    ``prefixes`` (P18): only antecedent items that carry one of them count, and
    a rule left without any matches nothing.
    """
    r = rules.select(label, "antecedent",
                     F.col("confidence").alias("rule_confidence"),
                     F.col("growth_rate").alias("rule_growth_rate"),
                     F.col("lift").alias("rule_lift"),
                     F.col("support").alias("rule_support"))
    if prefixes is not None:
        r = r.withColumn("antecedent", restrict_prefix("antecedent", *prefixes)).filter(F.size("antecedent") > 0)
    ents = entities.select(entity, F.col("features").alias("_efeat"))
    return containment_join(r, "antecedent", ents, "_efeat", target_key=[entity]).drop("_efeat")


def label_pairs(pairs: DataFrame, entities: DataFrame, known_pairs: DataFrame, test_pairs: DataFrame,
                negative_pairs: DataFrame | None = None, entity: str = ENTITY, label: str = LABEL) -> DataFrame:
    """J7, J8 and Q-8: known training pairs go; ``is_hit`` and ``known_negative`` flags; the entity's name.

    All of it depends on (entity, label) alone, so it may run after pairs are
    de-duplicated.  Pairs among the negative associations are kept, as in the source.
    """
    out = pairs.join(known_pairs.select(entity, label), [entity, label], "left_anti")
    hits = test_pairs.select(entity, label).distinct().withColumn("is_hit", F.lit(True))
    out = out.join(hits, [entity, label], "left").withColumn("is_hit", F.coalesce("is_hit", F.lit(False)))
    if negative_pairs is not None:
        negs = negative_pairs.select(entity, label).distinct().withColumn("known_negative", F.lit(True))
        out = out.join(negs, [entity, label], "left").withColumn(
            "known_negative", F.coalesce("known_negative", F.lit(False)))
    return out.join(entities.select(entity, "entity_name").hint("merge"), entity)


def candidates(rules: DataFrame, entities: DataFrame, known_pairs: DataFrame, test_pairs: DataFrame,
               negative_pairs: DataFrame | None = None, prefixes: Sequence[str] | None = None,
               entity: str = ENTITY, label: str = LABEL) -> DataFrame:
    """One row per rule and matching entity that is no known training pair."""
    return label_pairs(rule_matches(rules, entities, prefixes, entity, label), entities, known_pairs, test_pairs,
                       negative_pairs, entity, label)


def dedup_candidates(cands: DataFrame, entity: str = ENTITY, label: str = LABEL,
                     prefer: str = "shortest") -> DataFrame:
    """One row per (entity, label), of candidates or of bare rule matches.

    ``prefer="shortest"`` (the source's behaviour, trap Q-5): shortest
    antecedent, then growth desc, lift desc, antecedent text.
    ``prefer="confidence"``: highest rule confidence first, then the same keys.
    """
    if prefer not in ("shortest", "confidence"):
        raise ValueError(f"prefer must be 'shortest' or 'confidence', not {prefer!r}")
    payload = [c for c in cands.columns if c not in (entity, label)]
    first = (-F.col("rule_confidence")) if prefer == "confidence" else F.lit(0.0)
    key = F.struct(
        first.alias("_k0"),
        F.size("antecedent").alias("_k1"),
        (-F.col("rule_growth_rate")).alias("_k2"),
        (-F.col("rule_lift")).alias("_k3"),
        F.array_join("antecedent", " ").alias("_k4"),
        *[F.col(c) for c in payload])
    best = cands.groupBy(entity, label).agg(F.min(key).alias("_b"))
    return best.select(entity, label, *[F.col(f"_b.{c}").alias(c) for c in payload])


def confidence_order(entity: str = ENTITY, label: str = LABEL) -> list:
    """O4 with unique tie keys."""
    return [F.col("rule_confidence").desc(), F.col(entity).asc(), F.col(label).asc()]


def growth_order(entity: str = ENTITY, label: str = LABEL) -> list:
    return [F.col("rule_growth_rate").desc(), F.col("rule_confidence").desc(), F.col(entity).asc(),
            F.col(label).asc()]


def top_by_confidence(cands: DataFrame, n: int = 15) -> DataFrame:
    """Top-n by rule confidence (TakeOrderedAndProject: per-partition top-n, then merge)."""
    return cands.orderBy(*confidence_order()).limit(n)


def top_by_growth(cands: DataFrame, n: int = 15) -> DataFrame:
    """Top-n by growth rate, then confidence."""
    return cands.orderBy(*growth_order()).limit(n)


def long_tail(cands: DataFrame, n: int = 15, shown: int = 15, entity: str = ENTITY,
              label: str = LABEL) -> DataFrame:
    """Labels absent from both top lists; their first candidate in confidence order; first n."""
    shown_labels = (top_by_confidence(cands, shown).select(label)
                    .unionByName(top_by_growth(cands, shown).select(label)).distinct())
    rest = cands.join(F.broadcast(shown_labels), label, "left_anti")   # at most 2 * shown rows
    payload = [c for c in rest.columns if c != label]
    best = rest.groupBy(label).agg(F.min(F.struct(
        (-F.col("rule_confidence")).alias("_k1"), F.col(entity).alias("_k2"),
        *[F.col(c).alias(c) for c in payload if c != entity])).alias("_b"))
    out = best.select(label, F.col("_b._k2").alias(entity),
                      *[F.col(f"_b.{c}").alias(c) for c in payload if c != entity])
    return out.orderBy(*confidence_order()).limit(n)


def holdout_summary(cands: DataFrame, test_pairs: DataFrame | None = None,
                    known_pairs: DataFrame | None = None, entity: str = ENTITY, label: str = LABEL) -> DataFrame:
    """Candidates, hold-out hits and novel pairs, plus precision and recall.

    Recall is relative to the hold-out pairs that can be candidates at all
    (positive test pairs that are not known training pairs); its denominator is
    a scalar count.
    """
    out = cands.agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if(F.col("is_hit")).alias("hits"),
        F.count_if(~F.col("is_hit")).alias("novel"))
    out = out.withColumn("precision", F.when(F.col("n_candidates") > 0,
                                             F.col("hits").cast("double") / F.col("n_candidates").cast("double")))
    if test_pairs is None:
        return out
    reach = test_pairs.select(entity, label).distinct()
    if known_pairs is not None:
        reach = reach.join(known_pairs.select(entity, label), [entity, label], "left_anti")
    n_reach = reach.count()
    return out.withColumn("recall", F.when(F.lit(n_reach) > 0, F.col("hits").cast("double")
                                           / F.lit(float(n_reach))).otherwise(F.lit(None).cast("double")))


#: Bridge items of one entity or label that go to one part of the evidence join.
HUB_ITEMS = 100_000


@dataclass
class Bridges:
    """Written bridge tables with their measured degrees: items without prefix, upper-cased, distinct."""

    entity_items: DataFrame       # (entity, bridge_item), only items of some label
    label_items: DataFrame        # (label, bridge_item)
    entity_degrees: DataFrame     # (entity, _de)
    label_degrees: DataFrame      # (label, _dl)


def prepare_bridges(entity_bridge: DataFrame, label_bridge_pairs: DataFrame, entity: str = ENTITY, label: str = LABEL,
                    prefix: str = "GENE_") -> Bridges:
    """P7 on both sides; entity items that no label has are dropped before anything is joined."""
    item = strip_prefix_upper("bridge_item", prefix).alias("bridge_item")
    right = reliable(label_bridge_pairs.select(label, item).distinct(), "label-bridge")
    left = reliable(entity_bridge.select(entity, item).distinct()
                    .join(right.select("bridge_item").distinct(), "bridge_item", "left_semi"), "entity-bridge")
    return Bridges(left, right, left.groupBy(entity).agg(F.count(F.lit(1)).alias("_de")),
                   right.groupBy(label).agg(F.count(F.lit(1)).alias("_dl")))


def _met(pairs: DataFrame, items: DataFrame, degrees: DataFrame, key: str, degree: str, other: DataFrame, other_key: str,
         hub_items: int) -> DataFrame:
    """``pairs`` with the items of their ``key`` that the other side has too.

    Only a hub's pairs are repeated, once for each range of its items; a hub has
    at least ``hub_items`` of them, so there is at most one per so many rows.
    """
    parts = F.floor(F.col(degree) / F.lit(hub_items)).cast("int")
    hubs = degrees.filter(F.col(degree) >= hub_items).select(key, parts.alias("_parts"))
    dealt = items.join(hubs, key, "left").withColumn("_part", F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64("bridge_item"), F.col("_parts") + 1).cast("int"))).drop("_parts")
    asked = pairs.withColumn("_part", F.explode(F.sequence(F.lit(0), parts))).drop("_de", "_dl")
    return (asked.join(dealt, [key, "_part"]).join(other, [other_key, "bridge_item"], "left_semi")
            .select(key, other_key, "bridge_item"))


def bridge_evidence(cands: DataFrame, entity_bridge: DataFrame, label_bridge_pairs: DataFrame,
                    entity: str = ENTITY, label: str = LABEL, prefix: str = "GENE_") -> DataFrame:
    """R6 + P7 + P12 + P13: entity bridge ∩ label bridge per candidate."""
    return evidence(cands, prepare_bridges(entity_bridge, label_bridge_pairs, entity, label, prefix), entity, label)


def evidence(cands: DataFrame, bridges: Bridges, entity: str = ENTITY, label: str = LABEL,
             hub_items: int | None = None) -> DataFrame:
    """R6 on prepared bridges: each pair goes through the items of its smaller side, light or heavy.

    Where the entity has no more items than the label, the pair is expanded by
    the entity's items and these are looked up among the label's; elsewhere the
    other way round.  The rows made are the sum of the smaller degrees, whoever
    is a hub.  A candidate's list holds what both sides share.
    """
    hub = hub_items or HUB_ITEMS
    pairs = (cands.select(entity, label).distinct().join(bridges.entity_degrees, entity).join(bridges.label_degrees, label))
    light = _met(pairs.filter("_de <= _dl"), bridges.entity_items, bridges.entity_degrees, entity, "_de",
                 bridges.label_items, label, hub)
    heavy = _met(pairs.filter("_de > _dl"), bridges.label_items, bridges.label_degrees, label, "_dl",
                 bridges.entity_items, entity, hub)
    shared = light.unionByName(heavy)
    sets = shared.groupBy(entity, label).agg(F.array_sort(F.collect_list("bridge_item")).alias("bridge"))
    out = cands.join(sets, [entity, label], "left").withColumn(
        "bridge", F.coalesce(F.col("bridge"), F.array().cast("array<string>")))
    return out.withColumn("bridge_text", F.when(F.size("bridge") == 0, F.lit(INDIRECT))
                          .otherwise(sorted_text("bridge")))


def bridge_arms(labels: DataFrame, by_id: DataFrame, by_name: DataFrame, label: str = LABEL) -> DataFrame:
    """J3's match rate (Q-14): labels in all, those found by id, those found by name, those found by neither."""
    ids = by_id.select(F.col("label_key").alias("_k")).distinct().withColumn("_i", F.lit(1))
    names = by_name.select(F.col("name_key").alias("_n")).distinct().withColumn("_m", F.lit(1))
    lab = labels.select(label, "label_name").distinct()
    got = (lab.join(ids, mesh_id(label) == F.col("_k"), "left").join(names, F.lower("label_name") == F.col("_n"), "left"))
    return got.agg(F.count(F.lit(1)).alias("n_labels"), F.count("_i").alias("by_id"),
                   F.count_if(F.col("_i").isNull() & F.col("_m").isNotNull()).alias("by_name"),
                   F.count_if(F.col("_i").isNull() & F.col("_m").isNull()).alias("unmatched"))
