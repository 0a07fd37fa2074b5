"""The end-to-end contrast-mining flow, step by step.

A ``Flow`` runs on ``Inputs``: association rows (entity, label, label name,
status, split key), entity features, label-bridge rows and entity-bridge pairs.
``standin_inputs`` maps the test tables onto these roles; ``cli.inputs_from_files``
reads the source domain's XML / TSV / CSV files.  Each step is a lazy DataFrame
built from the previous ones; the association pass, the transaction tables, the
mining levels and the refinement levels are written to the shared checkpoint
folder.  One ``Flow`` is memoised per (application, data folder) so the
registered queries share mined rules instead of mining again.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emergent.operators import contrast, discover, mining, refine, split, sweep, transactions
from emergent.session import release, reliable
from emergent.sources import standin


@dataclass(frozen=True)
class Params:
    """Parameters of the registered queries (chosen for the stand-in data at sf0.01)."""

    min_support: float = 0.0005
    min_confidence: float = 0.05
    min_growth: float = 1.5
    prune_support: float = 0.04
    max_antecedent: int | None = None   # None: rules of any length
    conf_tol: float = 0.05
    supp_tol: float = 0.02
    gr_tol: float = 1.0
    top_n: int = 10
    max_per_label: int = 2
    show: int = 15
    sweep_supports: tuple = (0.002, 0.001, 0.0005)
    sweep_confidences: tuple = (0.05, 0.1, 0.15)
    test_percent: int = 20
    split_by_pair: bool = False      # Q-4: hash (entity, label) so a pair never sits on both sides
    support_base: str = "pruned"     # Q-1: rule-support denominator, "pruned" or "all"
    dedup_prefer: str = "shortest"   # Q-5: "shortest" antecedent or highest "confidence"


PARAMS = Params()


@dataclass
class Inputs:
    """Role tables of a flow.

    assoc_all: entity_id, label_id, label_name, status, split_key (text hashed by the split), place (optional row order)
    entities: entity_id, entity_name, features (sorted, distinct)
    bridge_rows: bridge_item, label_name, label_key
    entity_bridge: entity_id, bridge_item
    """

    assoc_all: DataFrame
    entities: DataFrame
    bridge_rows: DataFrame
    entity_bridge: DataFrame
    positive: tuple = split.POSITIVE_STATUS
    negative: tuple = split.NEGATIVE_STATUS


def standin_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    assoc = standin.associations(spark, sf_dir).withColumn("split_key", standin.split_key())
    return Inputs(assoc, standin.entities(spark, sf_dir), standin.label_bridge_rows(spark, sf_dir),
                  standin.entity_bridge_pairs(spark, sf_dir), standin.POSITIVE_STATUS, standin.NEGATIVE_STATUS)


@dataclass
class Flow:
    spark: SparkSession
    sf_dir: str | None
    params: Params = field(default_factory=Params)
    given: Inputs | None = None

    # --- inputs -----------------------------------------------------------------
    @cached_property
    def inputs(self) -> Inputs:
        return self.given if self.given is not None else standin_inputs(self.spark, self.sf_dir)

    @cached_property
    def assoc_all(self) -> DataFrame:
        return self.inputs.assoc_all

    @cached_property
    def assoc(self) -> DataFrame:
        """Classified and hash-split associations."""
        cls = split.classify(self.assoc_all, positive=self.inputs.positive, negative=self.inputs.negative)
        return split.hash_split(cls, self._split_key, self.params.test_percent)

    @property
    def _split_key(self):
        if self.params.split_by_pair:
            return F.concat_ws("-", F.col("entity_id").cast("string"), F.col("label_id").cast("string"))
        return F.col("split_key")

    @cached_property
    def entities(self) -> DataFrame:
        """Written once: transactions, pruning, every rule match and the candidates' names read it."""
        return reliable(self.inputs.entities, "entities")

    @cached_property
    def bridge_rows(self) -> DataFrame:
        return self.inputs.bridge_rows

    @cached_property
    def entity_bridge(self) -> DataFrame:
        return self.inputs.entity_bridge

    @cached_property
    def pair_table(self) -> DataFrame:
        """One pass over the associations: (entity, label, class, split) -> multiplicity, name.

        Every per-cell pair table and the label names derive from this small
        table, so the association join (the big input) is scanned once; rows
        of other statuses keep a null class and only feed the label names.
        """
        a = self.assoc_all
        pos, neg = list(self.inputs.positive), list(self.inputs.negative)
        cls = (F.when(F.col("status").isin(pos), F.lit(split.POSITIVE))
               .when(F.col("status").isin(neg), F.lit(split.NEGATIVE)))
        keyed = split.hash_split(a.withColumn("class", cls), self._split_key, self.params.test_percent)
        # Rows of other statuses only feed label names: collapse them to (label, name).
        keyed = (keyed.withColumn("entity_id", F.when(F.col("class").isNotNull(), F.col("entity_id")))
                 .withColumn("split", F.when(F.col("class").isNotNull(), F.col("split"))))
        # The name is a grouping key (hash aggregation with a count buffer); a
        # string max() buffer would force a sort-based aggregate over every row.
        last = [F.max("place").alias("place")] if "place" in a.columns else []
        t = keyed.groupBy("entity_id", "label_id", "label_name", "class", "split").agg(
            F.count(F.lit(1)).alias("multiplicity"), *last)
        return reliable(t, "pairs")

    def _cell(self, cls: str, part: str | None) -> DataFrame:
        df = self.pair_table.filter(F.col("class") == F.lit(cls))
        if part is not None:
            df = df.filter(F.col("split") == F.lit(part))
        return df.groupBy("entity_id", "label_id").agg(F.sum("multiplicity").alias("multiplicity"))

    @cached_property
    def pos_train_pairs(self) -> DataFrame:
        return self._cell(split.POSITIVE, split.TRAIN)

    @cached_property
    def pos_test_pairs(self) -> DataFrame:
        return self._cell(split.POSITIVE, split.TEST)

    @cached_property
    def neg_train_pairs(self) -> DataFrame:
        return self._cell(split.NEGATIVE, split.TRAIN)

    @cached_property
    def neg_pairs(self) -> DataFrame:
        return self._cell(split.NEGATIVE, None)

    @cached_property
    def tx_train(self) -> DataFrame:
        """Positive and negative training transactions, built and written in one job.

        Collapsed (entity, label, multiplicity, features) rows partitioned by
        class; every later step (pruning, each mining level, negative support,
        the sweep) reads this table instead of re-running the association joins.
        """
        pairs = (self.pair_table.filter((F.col("split") == F.lit(split.TRAIN)) & F.col("class").isNotNull())
                 .groupBy("class", "entity_id", "label_id").agg(F.sum("multiplicity").alias("multiplicity")))
        ents = self.entities.select("entity_id", "features").filter(F.size("features") > 0)
        # The features grow with the entities and are packed small on disk: their file size must not make them a broadcast.
        tx = pairs.join(ents.hint("merge"), "entity_id")
        return reliable(tx.select("class", "entity_id", "label_id", "multiplicity", "features"), "tx-train",
                        partition_by=("class",))

    def _tx(self, cls: str) -> DataFrame:
        return (self.tx_train.filter(F.col("class") == F.lit(cls))
                .select("entity_id", "label_id", "multiplicity", "features"))

    @cached_property
    def tx_pos(self) -> DataFrame:
        return self._tx(split.POSITIVE)

    @cached_property
    def tx_neg(self) -> DataFrame:
        return self._tx(split.NEGATIVE)

    @cached_property
    def n_pos(self) -> int:
        return transactions.total(self.tx_pos)

    @cached_property
    def n_neg(self) -> int:
        return transactions.total(self.tx_neg)

    # --- mining -----------------------------------------------------------------
    @cached_property
    def pruned(self) -> transactions.Pruned:
        p = transactions.prune_transactions(self.tx_pos, self.entities, self.params.min_support, self.n_pos)
        if p.changed:
            p.tx = reliable(p.tx, "tx-pruned", spread=True)
        return p

    @cached_property
    def pruned_for_report(self) -> transactions.Pruned:
        return transactions.prune_transactions(self.tx_pos, self.entities, self.params.prune_support, self.n_pos)

    @cached_property
    def mined(self) -> mining.Mined:
        p = self.params
        if p.support_base not in ("pruned", "all"):
            raise ValueError(f"support_base must be 'pruned' or 'all', not {p.support_base!r}")
        base = self.n_pos if p.support_base == "all" else None
        return mining.mine_label_rules(self.pruned.tx, p.min_support, p.min_confidence,
                                       max_antecedent=p.max_antecedent, support_base=base,
                                       ones=None if self.pruned.changed else self.pruned.item_counts)

    @cached_property
    def fpgrowth(self) -> tuple[DataFrame, DataFrame]:
        """M1 on the same pruned transactions: (itemsets, label rules), one MLlib fit."""
        p = self.params
        return mining.mine_fpgrowth(self.pruned.tx, p.min_support, p.min_confidence,
                                    label_prefix=standin.LABEL_PREFIX)

    @cached_property
    def rules(self) -> DataFrame:
        return self.mined.rules

    @cached_property
    def contrast(self) -> DataFrame:
        return contrast.growth_rate(contrast.negative_support(self.rules, self.tx_neg, self.n_neg))

    @cached_property
    def high(self) -> DataFrame:
        return contrast.high_contrast(self.contrast, self.params.min_growth)

    @cached_property
    def nonredundant(self) -> DataFrame:
        p = self.params
        return refine.remove_redundant(self.high, p.conf_tol, p.supp_tol, p.gr_tol)

    # --- discovery --------------------------------------------------------------
    @cached_property
    def label_names(self) -> DataFrame:
        return discover.label_names(self.pair_table, self.bridge_rows)

    @cached_property
    def candidates(self) -> DataFrame:
        return discover.candidates(self.nonredundant, self.entities, self.pos_train_pairs,
                                   self.pos_test_pairs, self.neg_pairs)

    def candidates_of(self, rules: DataFrame) -> DataFrame:
        """One row per (entity, label) of some rules' matches, written once.

        De-duplicated on ids first; the pair joins and the names follow on what is left.
        """
        best = discover.dedup_candidates(discover.rule_matches(rules, self.entities), prefer=self.params.dedup_prefer)
        d = discover.label_pairs(best, self.entities, self.pos_train_pairs, self.pos_test_pairs, self.neg_pairs)
        return reliable(d.join(self.label_names, "label_id", "left"), "candidates")

    @cached_property
    def candidates_dedup(self) -> DataFrame:
        """The rankings, the long tail, the hold-out summary and the bridge evidence all read it."""
        return self.candidates_of(self.nonredundant)

    def with_evidence(self, cands: DataFrame) -> DataFrame:
        return discover.evidence(cands, self.bridges)

    @cached_property
    def bridges(self) -> discover.Bridges:
        return discover.prepare_bridges(self.entity_bridge, self.label_bridge)

    def result_tables(self, rules: DataFrame, cands: DataFrame) -> dict[str, DataFrame]:
        """R2-R10 of some non-redundant rules and their candidates: what the source reports and writes.

        The main flow and the sweep's best cell both go through here.
        """
        p = self.params
        return {
            "rules": rules,
            "candidates": self.with_evidence(cands),
            "representative_rules": refine.top_representatives(rules, p.top_n),
            "diverse_top_rules": refine.diverse_top_rules(rules, p.top_n, p.max_per_label),
            "top_by_confidence": self.with_evidence(discover.top_by_confidence(cands, p.show)),
            "top_by_growth": self.with_evidence(discover.top_by_growth(cands, p.show)),
            "long_tail": self.with_evidence(discover.long_tail(cands, p.show, p.show)),
            "holdout_summary": discover.holdout_summary(cands, self.pos_test_pairs, self.pos_train_pairs),
        }

    @cached_property
    def results(self) -> dict[str, DataFrame]:
        return self.result_tables(self.nonredundant, self.candidates_dedup)

    @cached_property
    def best_results(self) -> dict[str, DataFrame]:
        """The same tables from the high-contrast rules of the sweep's best cell."""
        p = self.params
        best = sweep.best_cell_rules(self.sweep_result)
        if best is None:    # no cell has rules; the grid's table gives the columns, nothing is mined for them
            best = next(iter(self.sweep_result.high_rules.values()), None)
            best = (self.high if best is None else best).limit(0)
        rules = refine.remove_redundant(best, p.conf_tol, p.supp_tol, p.gr_tol)
        return self.result_tables(rules, self.candidates_of(rules))

    @cached_property
    def sweep_result(self) -> sweep.SweepResult:
        p = self.params
        return sweep.run_sweep(self.tx_pos, self.entities, self.tx_neg, self.pos_train_pairs,
                               self.pos_test_pairs, p.sweep_supports, p.sweep_confidences, p.min_growth,
                               p.max_antecedent)

    @cached_property
    def label_bridge(self) -> DataFrame:
        return discover.label_bridge(self.label_names, discover.bridge_by_id(self.bridge_rows),
                                     discover.bridge_by_name(self.bridge_rows))


def close() -> None:
    """Forget all flows and delete the tables that they wrote."""
    _FLOWS.clear()
    release()


_FLOWS: dict[tuple[str, str, Params], Flow] = {}


def flow(spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> Flow:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), params)
    f = _FLOWS.get(key)
    if f is None:
        f = Flow(spark, sf_dir.rstrip("/"), params)
        _FLOWS[key] = f
    return f
