"""Label-rule mining, without a bound on lengths or on how many sets are found.

M2 ``mine_label_rules`` (default).  Every transaction carries exactly one label,
so a rule ``S => label`` is a count of (S, label), and ``n_ante`` the sum of the
set's counts over all labels.  ``vertical.frequent_sets`` counts them on bitmaps
that are written once: a level shuffles counts, never rows.

M1 ``mine_fpgrowth`` runs MLlib's parallel FP-Growth on mixed item arrays and
keeps the rules of the same shape (F6).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.functions.items import INF, prefixed
from emergent.operators.transactions import total
from emergent.operators.vertical import frequent_sets
from emergent.session import reliable

OK = "ok"
EMPTY = "empty"                     # nothing left after pruning
NO_RULES = "no_rules"


@dataclass
class Mined:
    rules: DataFrame
    n_transactions: int
    min_count: int
    n_itemsets: int
    status: str
    itemsets: DataFrame | None = None    # frequent (antecedent, label) counts of every level


def restrict_support(mined: Mined, min_support: float) -> Mined:
    """Rules at a higher support from a run at a lower one on the same transactions.

    Exact: the counts of a (set, label) do not depend on the threshold, and
    every set frequent at the higher support was generated by the lower run,
    so the higher run's sets and rules are the lower run's filtered by
    ``n_rule >= ceil(min_support * N)``.
    """
    if mined.status == EMPTY or mined.itemsets is None:
        return mined
    mc = min_count_for(min_support, mined.n_transactions)
    if mc < mined.min_count:
        raise ValueError("restrict_support needs a support at least as high as the mined one")
    sets = mined.itemsets.filter(F.col("n_rule") >= F.lit(mc))
    n_sets = sets.count()
    if n_sets == 0:
        return Mined(mined.rules.limit(0), mined.n_transactions, mc, 0, NO_RULES, sets)
    return Mined(mined.rules.filter(F.col("n_rule") >= F.lit(mc)), mined.n_transactions, mc, n_sets, OK, sets)


def min_count_for(min_support: float, n: int) -> int:
    """Integer support threshold ``ceil(min_support * N)`` (computed once, on the driver)."""
    return int(math.ceil(float(min_support) * n))


def rule_metrics(counts: DataFrame, n_total: int | Column) -> DataFrame:
    """The metrics of a rule from integer counts (same operation order as MLlib).

    ``leverage`` is the support above that of independent sides; ``conviction``
    is infinite for a rule without exceptions.
    """
    n = (n_total if isinstance(n_total, Column) else F.lit(int(n_total))).cast("double")
    support = F.col("n_rule").cast("double") / n
    conf = F.col("n_rule").cast("double") / F.col("n_ante")
    p_label = F.col("n_label").cast("double") / n
    return (counts
            .withColumn("support", support)
            .withColumn("confidence", conf)
            .withColumn("lift", conf / p_label)
            .withColumn("leverage", support - (F.col("n_ante").cast("double") / n) * p_label)
            .withColumn("conviction", F.when(F.col("n_rule") == F.col("n_ante"), F.lit(INF))
                        .otherwise((F.lit(1.0) - p_label) / (F.lit(1.0) - conf))))


def empty_rules(tx: DataFrame, label: str) -> DataFrame:
    spark = tx.sparkSession
    label_type = tx.schema[label].dataType
    schema = T.StructType([
        T.StructField("antecedent", T.ArrayType(T.StringType())),
        T.StructField(label, label_type),
        T.StructField("length", T.IntegerType()),
        T.StructField("n_rule", T.LongType()),
        T.StructField("n_ante", T.LongType()),
        T.StructField("n_label", T.LongType()),
        T.StructField("support", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("lift", T.DoubleType()),
        T.StructField("leverage", T.DoubleType()),
        T.StructField("conviction", T.DoubleType()),
    ])
    return spark.createDataFrame([], schema)


def rule_counts(counts: DataFrame, mc: int, label: str, ante: Column | None = None) -> DataFrame:
    """``(antecedent, label, length, n_rule, n_ante)`` of the label counts that reach ``mc``.

    ``ante`` sums a set's counts (default: all of them).  The labels kept of an
    antecedent are at most ``n_ante / mc``, so their list is bounded by
    ``1 / min_support``.
    """
    hit = F.when(F.col(label).isNotNull() & (F.col("n") >= F.lit(mc)), F.struct(F.col(label), F.col("n").alias("n_rule")))
    return (counts.groupBy("antecedent", "length")
            .agg((F.sum("n") if ante is None else ante).alias("n_ante"), F.collect_list(hit).alias("_hits"))
            .select("antecedent", "length", "n_ante", F.explode("_hits").alias("_h"))
            .select("antecedent", "_h.*", "length", "n_ante"))


def mine_label_rules(tx: DataFrame, min_support: float, min_confidence: float,
                     max_antecedent: int | None = None,
                     label: str = "label_id", features: str = "features",
                     weight: str = "multiplicity", n_total: int | None = None,
                     support_base: int | None = None, ones: DataFrame | None = None) -> Mined:
    """M2: all rules ``antecedent => label`` (of at most ``max_antecedent`` items, if that is given).

    ``tx`` holds (label, features sorted+distinct, multiplicity).  The support
    threshold and, by default, the reported support and lift are relative to
    the transactions of ``tx`` (the pruned count in the source flow, trap Q-1);
    ``support_base`` gives another denominator for the reported metrics (e.g.
    the unpruned count).  ``ones`` are ``tx``'s item counts, if they are known.
    """
    n = total(tx, weight) if n_total is None else int(n_total)
    if n == 0:
        return Mined(empty_rules(tx, label), 0, 0, 0, EMPTY)
    mc = min_count_for(min_support, n)
    counts, n_sets = frequent_sets(tx, mc, max_antecedent, label, features, weight, ones)
    if counts is None:
        return Mined(empty_rules(tx, label), n, mc, 0, NO_RULES)
    allk = rule_counts(counts, mc, label)
    n_label = tx.groupBy(label).agg(F.sum(weight).alias("n_label"))
    base_n = n if support_base is None else int(support_base)
    rules = rule_metrics(allk.join(n_label, label), base_n).filter(F.col("confidence") >= F.lit(float(min_confidence)))
    # Every later step reads the rules several times.
    return Mined(reliable(rule_columns(rules, label), "rules"), n, mc, n_sets, OK, allk)


def rule_columns(rules: DataFrame, label: str, *more: str) -> DataFrame:
    return rules.select(*more, "antecedent", label, F.col("length").cast("int"), F.col("n_rule").cast("bigint"),
                        F.col("n_ante").cast("bigint"), F.col("n_label").cast("bigint"),
                        "support", "confidence", "lift", "leverage", "conviction")


#: Equal transactions that are expanded from one row at most; different ones that a task is meant to hold.
EXPAND_CHUNK, SETS_A_TASK = 4096, 100_000
#: So many of the most frequent items put the transactions in order.
ORDERED_ITEMS = 256


def expand_transactions(tx: DataFrame, label: str = "label_id", features: str = "features",
                        weight: str = "multiplicity", label_prefix: str = "LABEL_") -> DataFrame:
    """One row per original transaction with the mixed item array (input of MLlib).

    Equal transactions are counted first.  They stand in the order of the trees' paths, most frequent items
    first, so a task's trees share the beginnings of their paths, which are those of few other tasks.
    A count is expanded in chunks of at most ``EXPAND_CHUNK`` rows that are dealt apart, so
    transactions that hold a large share of all rows never build one huge array or one huge task.
    """
    items = F.array_sort(F.array_distinct(F.concat(F.col(features), F.array(prefixed(label_prefix, label)))))
    sets = reliable(tx.select(items.alias("items"), F.col(weight).cast("bigint").alias("_m"))
                    .groupBy("items").agg(F.sum("_m").alias("_m")), "item-sets")
    tasks = max(2 * tx.sparkSession.sparkContext.defaultParallelism, -(-sets.count() // SETS_A_TASK))
    often = (sets.select(F.explode("items").alias("item"), "_m").groupBy("item").agg(F.sum("_m").alias("n"))
             .orderBy(F.desc("n"), "item").limit(ORDERED_ITEMS).collect())
    path = F.array_intersect(F.array(*(F.lit(r["item"]) for r in often)).cast("array<string>"), "items")
    chunks = (sets.select("items", "_m", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                              F.floor((F.col("_m") - 1) / EXPAND_CHUNK).cast("bigint")))
                          .alias("_c"))
              .select("items", "_c", path.alias("_path"), F.least(F.lit(EXPAND_CHUNK).cast("bigint"),
                                                                  F.col("_m") - F.col("_c") * EXPAND_CHUNK).cast("int").alias("_k")))
    by = ("_path", "items", "_c")
    return (chunks.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
            .select("items", F.explode(F.array_repeat(F.lit(0), F.col("_k"))).alias("_r")).drop("_r"))


def mine_fpgrowth(tx: DataFrame, min_support: float, min_confidence: float,
                  max_len: int | None = None, label: str = "label_id", features: str = "features",
                  weight: str = "multiplicity", label_prefix: str = "LABEL_",
                  num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M1: MLlib FP-Growth; returns (itemsets, label rules), a cross-check of M2.

    ``max_len`` bounds the items of a set, if it is given.

    Rules keep the F6 shape: no label in the antecedent, one consequent, a label.
    The model's itemsets are written once, as every use of them grows them from
    the trees again, and the rules of that shape are joined from them: a set with
    one label against the set without it, with MLlib's order of operations.
    """
    from pyspark.ml.fpm import FPGrowth

    rows = expand_transactions(tx, label, features, weight, label_prefix)
    fp = FPGrowth(itemsCol="items", minSupport=float(min_support), minConfidence=float(min_confidence))
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(rows)
    every = reliable(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq")),
                     "itemsets")
    itemsets = every if max_len is None else every.filter(F.size("items") <= max_len)
    n = F.lit(total(tx.filter(F.col(features).isNotNull()), weight)).cast("double")

    def is_label(x: Column) -> Column:
        return x.startswith(label_prefix)

    labelled = (itemsets.withColumn("_labels", F.filter("items", is_label))
                .filter((F.size("_labels") == 1) & (F.size("items") > 1))
                .select(F.filter("items", lambda x: ~is_label(x)).alias("antecedent"), F.get("_labels", 0).alias("_label"),
                        F.col("freq").cast("double").alias("_union")))
    antes = every.select(F.col("items").alias("antecedent"), F.col("freq").cast("double").alias("_ante"))
    singles = every.filter(F.size("items") == 1).select(F.get("items", 0).alias("_label"), (F.col("freq").cast("double") / n).alias("_p"))
    confidence = F.col("_union") / F.col("_ante")
    rules = (labelled.join(antes, "antecedent").join(singles, "_label")
             .filter(confidence >= F.lit(float(min_confidence)))
             .select("antecedent",
                     F.col("_label").substr(F.lit(len(label_prefix) + 1), F.length("_label"))
                     .cast(tx.schema[label].dataType).alias(label),
                     F.size("antecedent").alias("length"),
                     (F.col("_union") / n).alias("support"), confidence.alias("confidence"),
                     (confidence / F.col("_p")).alias("lift")))
    return itemsets, rules
