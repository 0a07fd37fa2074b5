"""Support x confidence sweep on one lattice.

Every support of the grid prunes items and labels at its own threshold, but
pruning never changes the count of a (set, label) that survives it.  So the
sets are mined once, on unpruned transactions at the lowest count that any cell
asks for; a set's antecedent count at a support sums its label counts over the
labels frequent there, and a label's size counts its transactions that keep an
item.  The rules of all supports are one table with the support's index, with
one negative-support join and one rule x entity join over the distinct rules.
Confidence cells never multiply rows.  Only statuses and a few totals reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emergent.operators.containment import containment_join
from emergent.operators.contrast import growth_rate, high_contrast, negative_support
from emergent.operators.mining import empty_rules, min_count_for, rule_columns, rule_counts, rule_metrics
from emergent.operators.transactions import total
from emergent.operators.vertical import frequent_sets, item_label_counts
from emergent.session import reliable

# Fixed values of the source's sweep.
SUPPORT_GRID = (0.05, 0.03, 0.02, 0.015, 0.01, 0.008, 0.005, 0.003, 0.0016)
CONFIDENCE_GRID = (0.15, 0.25, 0.35, 0.45)
HIT_WEIGHT = 10000

OK = "ok"
NO_RULES = "no_rules"

REPORT_SCHEMA = T.StructType([
    T.StructField("supp_idx", T.IntegerType()),
    T.StructField("conf_idx", T.IntegerType()),
    T.StructField("supp", T.DoubleType()),
    T.StructField("conf", T.DoubleType()),
    T.StructField("n_rules", T.LongType()),
    T.StructField("hits", T.LongType()),
    T.StructField("novel", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _at_least(spark: SparkSession, df: DataFrame, value: str, supports: Sequence[float], confidences: Sequence[float],
              aggs: dict[str, Column]) -> DataFrame:
    """Per cell, aggregates over the rows of its support whose value is >= its confidence.

    Each row gets ``k`` = how many grid confidences it meets (a column
    expression, no replication of rows per cell); one aggregate over ``k`` and a
    cumulative sum over the grid ranks (frames bounded by the parameter list)
    give every cell's counts.
    """
    order = sorted(range(len(confidences)), key=lambda i: confidences[i])
    cells = spark.createDataFrame([(si, i, r + 1) for si in range(len(supports)) for r, i in enumerate(order)],
                                  "supp_idx int, conf_idx int, _k int")
    w = Window.partitionBy("supp_idx").orderBy(F.col("_k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k = sum((F.col(value) >= F.lit(float(c))).cast("int") for c in confidences)
    hist = df.groupBy("supp_idx", k.alias("_k")).agg(*[a.alias(n) for n, a in aggs.items()])
    return cells.join(hist, ["supp_idx", "_k"], "left").select(
        "supp_idx", "conf_idx", *[F.sum(F.coalesce(F.col(n), F.lit(0))).over(w).cast("bigint").alias(n) for n in aggs])


def _matches(rules: DataFrame, entities: DataFrame, known_pairs: DataFrame, test_pairs: DataFrame) -> DataFrame:
    """(entity, label, antecedent, hit flag) for every rule matching an unknown pair."""
    ents = entities.select("entity_id", F.col("features").alias("_efeat"))
    return (containment_join(rules.select("label_id", "antecedent"), "antecedent", ents, "_efeat",
                             target_key=["entity_id"]).drop("_efeat")
            .join(known_pairs.select("entity_id", "label_id"), ["entity_id", "label_id"], "left_anti")
            .join(test_pairs.select("entity_id", "label_id").distinct().withColumn("_hit", F.lit(True)),
                  ["entity_id", "label_id"], "left"))


def grid_rules(tx: DataFrame, entities: DataFrame, supports: Sequence[float], min_confidence: float,
               max_antecedent: int | None = None) -> DataFrame:
    """The rules of every support, after its own pruning, from one mining run: ``supp_idx`` and the columns of a rule."""
    spark, m = tx.sparkSession, len(supports)
    n_all = total(tx)
    floors = [float(s) * n_all for s in supports]
    ones = item_label_counts(tx, "label_id", "features", "multiplicity")
    items = ones.groupBy("item").agg(F.sum("n").alias("_freq"))
    # A transaction survives where its label and its most frequent item do.
    best = (entities.select("entity_id", F.explode("features").alias("item")).join(items, "item")
            .groupBy("entity_id").agg(F.max("_freq").alias("_best")))
    kept = [F.sum(F.when(F.col("_best") >= F.lit(f), F.col("multiplicity")).otherwise(0)) for f in floors]
    sizes = reliable(tx.join(best, "entity_id").groupBy("label_id").agg(
        F.sum("multiplicity").alias("_lfreq"), F.array(*kept).alias("_sizes")), "label-sizes")
    row = sizes.agg(*(F.sum(F.when(F.col("_lfreq") >= F.lit(f), F.col("_sizes")[i])) for i, f in enumerate(floors))).first()
    totals = [int(x or 0) for x in row]
    cuts = [min_count_for(s, n) for s, n in zip(supports, totals)]
    alive = [c for c, n in zip(cuts, totals) if n > 0]
    lowest = max(1, min(alive, default=1))
    counts, _ = (frequent_sets(tx, lowest, max_antecedent, ones=ones) if alive else (None, 0))
    if counts is None:
        return empty_rules(tx, "label_id").withColumn("supp_idx", F.lit(0))
    labelled = counts.join(sizes.select("label_id", "_lfreq"), "label_id", "left")
    antes = F.array(*(F.sum(F.when(F.col("_lfreq") >= F.lit(f), F.col("n")).otherwise(0)) for f in floors))
    sets = rule_counts(labelled, lowest, "label_id", antes)
    least = (counts.select("antecedent").distinct().select("antecedent", F.explode("antecedent").alias("item"))
             .join(items, "item").groupBy("antecedent").agg(F.min("_freq").alias("_least")))
    cell = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(f).alias("floor"), F.lit(c).alias("cut"),
                                        F.lit(n).alias("total")) for i, (f, c, n) in enumerate(zip(floors, cuts, totals)))))
    rows = (sets.withColumnRenamed("n_ante", "_antes").join(sizes, "label_id").join(least, "antecedent")
            .withColumn("_cell", cell)
            .filter("_cell.total > 0 AND n_rule >= _cell.cut AND _lfreq >= _cell.floor AND _least >= _cell.floor"))
    i = F.col("_cell.i")
    rows = rows.withColumn("supp_idx", i).withColumn("n_ante", F.get("_antes", i)).withColumn("n_label", F.get("_sizes", i))
    rules = rule_metrics(rows, F.col("_cell.total")).filter(F.col("confidence") >= F.lit(float(min_confidence)))
    return reliable(rule_columns(rules, "label_id", "supp_idx"), "grid-rules")


@dataclass
class SweepResult:
    report: DataFrame
    high_rules: dict[int, DataFrame] = field(default_factory=dict)   # support index -> rules


def sweep(tx_pos: DataFrame, entities: DataFrame, neg_tx: DataFrame, known_pairs: DataFrame,
          test_pairs: DataFrame, supports: Sequence[float] = SUPPORT_GRID,
          confidences: Sequence[float] = CONFIDENCE_GRID, min_growth: float = 3.0,
          max_antecedent: int | None = None) -> DataFrame:
    """G1-G5 report (see ``run_sweep``)."""
    return run_sweep(tx_pos, entities, neg_tx, known_pairs, test_pairs, supports, confidences,
                     min_growth, max_antecedent).report


def run_sweep(tx_pos: DataFrame, entities: DataFrame, neg_tx: DataFrame, known_pairs: DataFrame,
              test_pairs: DataFrame, supports: Sequence[float] = SUPPORT_GRID,
              confidences: Sequence[float] = CONFIDENCE_GRID, min_growth: float = 3.0,
              max_antecedent: int | None = None) -> SweepResult:
    """One report row per cell of the grid (supp, conf, n_rules, hits, novel, status).

    Statuses: ``ok``; ``no_rules`` (nothing mined at this cell, including an
    empty pruned set).  Every cell is evaluated.
    """
    spark = tx_pos.sparkSession
    if not supports or not confidences:
        return SweepResult(spark.createDataFrame([], REPORT_SCHEMA).withColumn("score", F.lit(0).cast("bigint")), {})
    rules = grid_rules(tx_pos, entities, supports, min(confidences), max_antecedent)
    keys = rules.select("label_id", "antecedent").distinct()
    against = negative_support(keys, neg_tx, total(neg_tx))
    high = reliable(high_contrast(growth_rate(rules.join(against, ["label_id", "antecedent"])), min_growth), "grid-high")
    matched = _matches(high.select("label_id", "antecedent").distinct(), entities, known_pairs, test_pairs)
    pairs = (matched.join(high.select("supp_idx", "label_id", "antecedent", "confidence"), ["label_id", "antecedent"])
             .groupBy("supp_idx", "entity_id", "label_id").agg(F.max("confidence").alias("_best"),
                                                               F.max("_hit").alias("_hit")))

    def cells(df: DataFrame, value: str, aggs: dict[str, Column]) -> DataFrame:
        return _at_least(spark, df, value, supports, confidences, aggs)

    counted = (cells(rules, "confidence", {"n_mined": F.count(F.lit(1))})
               .join(cells(high, "confidence", {"n_rules": F.count(F.lit(1))}), ["supp_idx", "conf_idx"])
               .join(cells(pairs, "_best", {"hits": F.count_if(F.col("_hit").isNotNull()),
                                            "novel": F.count_if(F.col("_hit").isNull())}), ["supp_idx", "conf_idx"]))
    grid = spark.createDataFrame([(i, j, float(s), float(c)) for i, s in enumerate(supports)
                                  for j, c in enumerate(confidences)], "supp_idx int, conf_idx int, supp double, conf double")
    report = grid.join(counted, ["supp_idx", "conf_idx"]).select(
        "supp_idx", "conf_idx", "supp", "conf", "n_rules", "hits", "novel",
        F.when(F.col("n_mined") == 0, F.lit(NO_RULES)).otherwise(F.lit(OK)).alias("status"))
    report = reliable(report.withColumn("score", F.col("hits") * F.lit(HIT_WEIGHT) + F.col("n_rules")), "sweep-report")
    return SweepResult(report, {i: high.filter(F.col("supp_idx") == i).drop("supp_idx") for i in range(len(supports))})


def best_cell(report: DataFrame) -> DataFrame:
    """The first strict maximum of the score in grid order."""
    return report.orderBy(F.col("score").desc(), F.col("supp_idx").asc(), F.col("conf_idx").asc()).limit(1)


def best_cell_rules(result: SweepResult) -> DataFrame | None:
    """G6 input: the high-contrast rules of the best cell (its support's rules with conf >= its conf).

    Only the winning cell's two parameters reach the driver.  ``None`` when no
    cell produced rules.
    """
    best = best_cell(result.report).select("supp_idx", "conf", "status").first()
    if best is None or best["status"] != OK or best["supp_idx"] not in result.high_rules:
        return None
    return result.high_rules[best["supp_idx"]].filter(F.col("confidence") >= F.lit(float(best["conf"])))
