"""The file-based flow end to end on toy source files."""

import os

from emergent.plans.cli import inputs_from_files, run
from emergent.plans.flow import Flow, Params

XML = """<?xml version="1.0"?>
<drugbank xmlns="http://www.drugbank.ca">
  <drug><drugbank-id primary="true">DBA</drugbank-id><name>Alpha</name>
    <targets><target><name>Kinase one</name><polypeptide><gene-name>kin1</gene-name></polypeptide></target></targets></drug>
  <drug><drugbank-id primary="true">DBB</drugbank-id><name>Beta</name>
    <targets><target><name>Kinase one</name><polypeptide><gene-name>KIN1</gene-name></polypeptide></target>
             <target><name>Pump</name></target></targets></drug>
  <drug><drugbank-id primary="true">DBC</drugbank-id><name>Gamma</name>
    <targets><target><name>Channel</name><polypeptide><gene-name>chn2</gene-name></polypeptide></target></targets></drug>
</drugbank>
"""

TSV = "# CTD-like rows\nKIN1\t1\tFever\tMESH:D1\nCHN2\t2\tCough\tMESH:D2\n"


def test_file_flow_end_to_end(spark, tmpdir_path):
    paths = {}
    for name, text in (("drugs.xml", XML), ("genes.tsv", TSV)):
        paths[name] = os.path.join(tmpdir_path, name)
        with open(paths[name], "w") as fh:
            fh.write(text)
    rows = ["drug_name,drugbank_id,ind_name,ind_id,NCT,status"]
    rows += [f"Alpha,DBA,Fever,D1,NA{i},Approved" for i in range(30)]       # Kinase one => D1
    rows += [f"Gamma,DBC,Fever,D1,NC{i},Terminated" for i in range(30)]     # never has Kinase one
    rows += [f"Gamma,DBC,Cough,D2,ND{i},Approved" for i in range(10)]
    paths["assoc.csv"] = os.path.join(tmpdir_path, "assoc.csv")
    with open(paths["assoc.csv"], "w") as fh:
        fh.write("\n".join(rows) + "\n")
    inputs = inputs_from_files(spark, paths["drugs.xml"], paths["genes.tsv"], paths["assoc.csv"],
                               input_order=True)
    params = Params(min_support=0.05, min_confidence=0.1, min_growth=3.0, prune_support=0.05,
                    sweep_supports=(0.1, 0.05), sweep_confidences=(0.1, 0.5))
    out = os.path.join(tmpdir_path, "out")
    written = run(Flow(spark, None, params, given=inputs), out, with_sweep=True)
    cands = spark.read.option("header", "true").csv(written["candidates"]).collect()
    by_pair = {(r.entity_id, r.label_id): r for r in cands}
    assert ("DBB", "D1") in by_pair                       # Beta shares Kinase one with Alpha
    assert by_pair[("DBB", "D1")].bridge_text == "KIN1"   # bridge via MESH:D1
    assert ("DBA", "D1") not in by_pair                   # known training pair
    rules = spark.read.option("header", "true").csv(written["rules"]).collect()
    assert any(r.antecedent == "TARGET_Kinase_one" and r.label_id == "D1" for r in rules)
    assert spark.read.parquet(written["splits"]).count() == 70
    assert spark.read.option("header", "true").csv(written["sweep_report"]).count() == 4
    best = spark.read.option("header", "true").csv(written["sweep_best_candidates"])
    assert "bridge_text" in best.columns and "bridge_text" in spark.read.option("header", "true").csv(
        written["top_by_confidence"]).columns
