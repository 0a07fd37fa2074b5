"""Negative support and growth rate (emerging patterns).

``support_neg`` is the share of *all* negative transactions that contain the
rule's antecedent and label; growth rate is ``support / support_neg`` and +inf
(a jumping emerging pattern) when no negative transaction matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.functions.items import INF
from emergent.operators.containment import containment_join
from emergent.operators.transactions import total


def negative_support(rules: DataFrame, neg_tx: DataFrame, n_negative: int | None = None,
                     label: str = "label_id", features: str = "features",
                     weight: str = "multiplicity") -> DataFrame:
    """Per rule, matching negative transactions (containment join keyed by (label, rarest item))."""
    n_neg = total(neg_tx, weight) if n_negative is None else int(n_negative)
    rule_keys = rules.select(label, "antecedent")
    # Equal transactions of different entities count together before the join.
    targets = neg_tx.groupBy(label, F.col(features).alias("_nfeat")).agg(F.sum(weight).alias("_nw"))
    matched = (containment_join(rule_keys, "antecedent", targets, "_nfeat", on=[label])
               .groupBy(label, "antecedent").agg(F.sum("_nw").alias("n_neg_match")))
    out = rules.join(matched, [label, "antecedent"], "left")
    n = F.lit(n_neg).cast("double")
    return (out.withColumn("n_neg_match", F.coalesce(F.col("n_neg_match"), F.lit(0)).cast("bigint"))
            .withColumn("n_neg_total", F.lit(n_neg).cast("bigint"))
            .withColumn("support_neg", F.when(F.lit(n_neg) > 0, F.col("n_neg_match").cast("double") / n)
                        .otherwise(F.lit(0.0))))


def growth_rate(df: DataFrame) -> DataFrame:
    """A10: ``support / support_neg``; +inf when the negative support is zero."""
    return (df.withColumn("growth_rate", F.when(F.col("support_neg") == F.lit(0.0), F.lit(INF))
                          .otherwise(F.col("support") / F.col("support_neg")))
            .withColumn("is_jumping", F.col("support_neg") == F.lit(0.0)))


def high_contrast(df: DataFrame, min_growth: float = 3.0) -> DataFrame:
    """F7 + R4: strict ``growth_rate > min_growth`` (infinity passes).

    The order (growth rate, lift, both descending) is applied where rows are reported.
    """
    return df.filter(F.col("growth_rate") > F.lit(float(min_growth)))
