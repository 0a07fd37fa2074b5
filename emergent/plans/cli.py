"""Run the discovery flow on the source domain's files and write every result table.

    python -m emergent.plans.cli --entities-xml drugs.xml --bridge-tsv genes.tsv \
        --associations-csv assoc.csv --out results/ [--sweep]

Inputs: an entity XML (``rowTag`` records with a primary id, a name and targets
with gene names), a headerless commented label-bridge TSV (bridge item, label
name and label id at configurable positions) and an association CSV with a
header (entity id, label id, label name, status).  Outputs (under ``--out``):
the class x split association table, the non-redundant high-contrast rules,
the candidates with bridge evidence, representative / diverse rules, the three
rankings with evidence, the hold-out summary and, with ``--sweep``, the sweep
report and the same tables (``sweep_best_*``) for the rules of its best cell.  The session comes from ``spark-submit``; the
checkpoint folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emergent.functions.items import INF
from emergent.operators import refine, split, sweep
from emergent.plans.flow import Flow, Inputs, Params, close
from emergent.session import reliable
from emergent.sources import delimited, sinks, xml

# Fixed defaults of the source's main flow.
SOURCE_PARAMS = Params(min_support=0.003, min_confidence=0.15, min_growth=3.0, prune_support=0.003,
                       conf_tol=refine.CONF_TOL, supp_tol=refine.SUPP_TOL, gr_tol=refine.GROWTH_TOL,
                       sweep_supports=sweep.SUPPORT_GRID, sweep_confidences=sweep.CONFIDENCE_GRID)


def inputs_from_files(spark: SparkSession, entities_xml: str, bridge_tsv: str, associations_csv: str,
                      positive=split.POSITIVE_STATUS, negative=split.NEGATIVE_STATUS,
                      bridge_positions=(0, 2, 3), row_tag: str = "drug", null_tokens=("",),
                      input_order: bool = False) -> Inputs:
    """Role tables from the three source files (the XML is parsed once and written).

    With ``input_order`` the last of several records or names of one id counts,
    as in the order of the files, else the greatest.
    """
    ents = reliable(xml.read_entity_xml(spark, entities_xml, row_tag, duplicates="last" if input_order else "greatest"),
                    "entities")
    entities = ents.select("entity_id", "entity_name", F.array_sort("features").alias("features"))
    entity_bridge = ents.select("entity_id", F.explode("bridge").alias("bridge_item")).distinct()
    bridge_rows = delimited.read_label_bridge_tsv(spark, bridge_tsv, bridge_positions, null_tokens=null_tokens)
    raw = delimited.read_associations_csv(spark, associations_csv, null_tokens=null_tokens,
                                          place="place" if input_order else None)
    # A row's side of the split depends only on its content (identical rows share a side).
    key = F.concat_ws("\u0001", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in raw.columns if c != "place"])
    return Inputs(raw.withColumn("split_key", key), entities, bridge_rows, entity_bridge,
                  tuple(positive), tuple(negative))


def _gr_text(df: DataFrame, c: str) -> DataFrame:
    if c not in df.columns:
        return df
    return df.withColumn(c, F.when(F.col(c) == F.lit(INF), F.lit(None).cast("double")).otherwise(F.col(c)))


def run(flow: Flow, out_dir: str, with_sweep: bool = False) -> dict[str, str]:
    """Compute and write every result table; returns name -> path."""
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> None:
        paths[name] = os.path.join(out_dir, name)
        sinks.write_csv(df, paths[name])

    sinks.write_splits(flow.assoc.drop("split_key", "place"), os.path.join(out_dir, "splits"))
    paths["splits"] = os.path.join(out_dir, "splits")

    def put_all(tables: dict[str, DataFrame], prefix: str) -> None:
        for name, df in tables.items():
            out = _gr_text(_gr_text(_gr_text(df, "growth_rate"), "rule_growth_rate"), "conviction")
            path = os.path.join(out_dir, prefix + name)
            if name == "rules":
                sinks.write_rules(out, path, fmt="csv")
            elif name == "candidates":
                sinks.write_candidates(out.drop("bridge"), path)
            else:
                sinks.write_csv(out.drop("bridge"), path)
            paths[prefix + name] = path

    put_all(flow.results, "")
    if with_sweep:
        put("sweep_report", flow.sweep_result.report)
        put_all(flow.best_results, "sweep_best_")
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--entities-xml", required=True)
    ap.add_argument("--bridge-tsv", required=True)
    ap.add_argument("--associations-csv", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--input-order", action="store_true", help="of several records of one id the last one counts")
    ap.add_argument("--source-nulls", action="store_true", help="read NA, null, None and the like as missing")
    ap.add_argument("--min-support", type=float, default=SOURCE_PARAMS.min_support)
    ap.add_argument("--min-confidence", type=float, default=SOURCE_PARAMS.min_confidence)
    ap.add_argument("--min-growth", type=float, default=SOURCE_PARAMS.min_growth)
    ap.add_argument("--sweep", action="store_true")
    ap.add_argument("--split-by-pair", action="store_true",
                    help="hash (entity, label) for the split so a pair never sits on both sides")
    ap.add_argument("--support-base", choices=("pruned", "all"), default="pruned",
                    help="denominator of the reported rule support")
    ap.add_argument("--dedup-prefer", choices=("shortest", "confidence"), default="shortest",
                    help="which rule represents an (entity, label) candidate")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("emergent").getOrCreate()
    params = Params(**{**SOURCE_PARAMS.__dict__, "min_support": a.min_support, "prune_support": a.min_support,
                       "min_confidence": a.min_confidence, "min_growth": a.min_growth,
                       "split_by_pair": a.split_by_pair, "support_base": a.support_base,
                       "dedup_prefer": a.dedup_prefer})
    inputs = inputs_from_files(spark, a.entities_xml, a.bridge_tsv, a.associations_csv, input_order=a.input_order,
                               null_tokens=delimited.SOURCE_NULL_TOKENS if a.source_nulls else ("",))
    for name, path in run(Flow(spark, None, params, given=inputs), a.out, a.sweep).items():
        print(f"{name}\t{path}")
    close()


if __name__ == "__main__":
    main()
