"""Rule refinement.

R1 walks antecedent lengths upward.  A rule of length k is redundant when a
*kept* shorter rule with the same label has an antecedent that is a subset of
it and close metrics.  The subset test is the containment join (equi-join on the
label and the subset's rarest item, then verified), so no rule's subsets are
enumerated, whatever its length.  Rules of equal length are never subsets of each
other, so the order inside a length cannot change the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emergent.functions.items import INF, finite_growth
from emergent.operators.containment import containment_join
from emergent.session import reliable

# Fixed defaults of the source's refiner.
CONF_TOL = 0.01
SUPP_TOL = 0.002
GROWTH_TOL = 1.0
W_CONFIDENCE = 100
W_GROWTH = 2.0
W_SUPPORT = 2000
NO_FINITE_GROWTH = 10.0     # stands for the largest finite growth rate when there is none
INF_CAP_FACTOR = 1.5


def remove_redundant(rules: DataFrame, conf_tol: float = CONF_TOL, supp_tol: float = SUPP_TOL,
                     gr_tol: float = GROWTH_TOL, label: str = "label_id",
                     checkpoint: bool = True) -> DataFrame:
    """Keep a rule unless a kept shorter sub-rule of the same label is within tolerance."""
    if checkpoint:
        rules = reliable(rules)
    rules = rules.withColumn("_len", F.size("antecedent"))
    max_len = rules.agg(F.max("_len")).first()[0]
    if max_len is None:
        return rules.drop("_len")
    kept = rules.filter(F.col("_len") == 1)
    for k in range(2, int(max_len) + 1):
        level = rules.filter(F.col("_len") == k)
        longer = level.select(label, "confidence", "support", "growth_rate", F.col("antecedent").alias("_items"))
        older = kept.select(label, "antecedent", F.col("confidence").alias("_c"),
                            F.col("support").alias("_s"), F.col("growth_rate").alias("_g"))
        close = (
            (F.abs(F.col("confidence") - F.col("_c")) <= F.lit(conf_tol))
            & (F.abs(F.col("support") - F.col("_s")) <= F.lit(supp_tol))
            & ((F.abs(finite_growth("growth_rate") - finite_growth("_g")) <= F.lit(gr_tol))
               | ((F.col("growth_rate") == F.lit(INF)) & (F.col("_g") == F.lit(INF))))
        )
        redundant = (containment_join(older, "antecedent", longer, "_items", on=[label]).filter(close)
                     .select(label, F.col("_items").alias("antecedent")).distinct())
        left = level.join(redundant, [label, "antecedent"], "left_anti")
        # A length is written once and only read by the longer ones.
        kept = kept.unionByName(reliable(left, f"kept-{k}") if checkpoint else left)
    return kept.drop("_len")


def infinity_cap(rules: DataFrame) -> float:
    """The stand-in for +inf, 1.5 x the largest finite growth rate (a scalar aggregate)."""
    mx = rules.agg(F.max(F.when(F.col("growth_rate") != F.lit(INF), F.col("growth_rate")))).first()[0]
    return (NO_FINITE_GROWTH if mx is None else float(mx)) * INF_CAP_FACTOR


def score_rules(rules: DataFrame, w1: float = W_CONFIDENCE, w2: float = W_GROWTH,
                w3: float = W_SUPPORT) -> DataFrame:
    """``w1*confidence + w2*growth + w3*support`` with +inf replaced by the cap."""
    cap = infinity_cap(rules)
    g = F.when(F.col("growth_rate") == F.lit(INF), F.lit(cap)).otherwise(F.col("growth_rate"))
    score = (F.col("confidence") * F.lit(w1)) + (g * F.lit(w2)) + (F.col("support") * F.lit(w3))
    return rules.withColumn("rep_score", score)


def representative_rules(rules: DataFrame, label: str = "label_id", **weights) -> DataFrame:
    """Per label, the rule with the highest score.

    Ties go to the shorter antecedent (the source keeps the first rule in its
    length order), then to the greater antecedent text.  ``max_by`` is a
    partial aggregate, so a label holding most rules is combined map side.
    """
    scored = score_rules(rules, **weights)
    best = scored.groupBy(label).agg(F.max_by(
        F.struct(*[F.col(c) for c in scored.columns if c != label]),
        F.struct(F.col("rep_score"), (-F.size("antecedent")).alias("_neg_len"),
                 F.array_join("antecedent", " ").alias("_txt"))).alias("r"))
    return best.select(label, "r.*")


def top_representatives(rules: DataFrame, n: int = 10, label: str = "label_id", **weights) -> DataFrame:
    """R3 + O5: representatives by score, the highest first, the first ``n``; ties by label."""
    return representative_rules(rules, label, **weights).orderBy(F.col("rep_score").desc(), F.col(label).asc()).limit(n)


def diverse_top_rules(rules: DataFrame, top_n: int = 10, max_per_label: int = 2,
                      label: str = "label_id") -> DataFrame:
    """R2: global order growth desc, lift desc; at most ``max_per_label`` per label; first ``top_n``.

    Equivalent to the source's greedy scan: a per-label rank (pushed below the
    shuffle as a window group limit) then a global top-n.
    """
    text = F.array_join("antecedent", " ")
    order = [F.col("growth_rate").desc(), F.col("lift").desc(), F.col(label).asc(), text.asc()]
    w = Window.partitionBy(label).orderBy(F.col("growth_rate").desc(), F.col("lift").desc(), text.asc())
    ranked = rules.withColumn("rank_in_label", F.row_number().over(w)).filter(
        F.col("rank_in_label") <= F.lit(max_per_label))
    return ranked.orderBy(*order).limit(top_n)
