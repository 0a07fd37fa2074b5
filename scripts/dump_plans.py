"""Write the physical plans of the key stages to PLANS.md.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emergent.operators import contrast, discover, transactions  # noqa: E402
from emergent.operators.containment import containment_join  # noqa: E402
from emergent.plans.flow import close, flow  # noqa: E402
from emergent.session import local_session  # noqa: E402

WIDTH = 200
NOTES = {
    "association pass": "One scan of lineitem with four pruned columns; the only shuffle carries partial counts.",
    "transactions": "Pairs join the features once; the result is written and read by every later stage.",
    "containment": "Rarest-item keys, salted parts, one equi-join, verification in the same stage.",
    "negative support": "Equal negative transactions are counted first; keys with many rows are salted.",
    "candidates": "Rule matches on ids alone, de-duplicated before the known, hold-out and negative joins.",
    "bridge evidence": "Keyed by (entity, part of the item's hash).",
}


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plans of large sides
    f = flow(spark, sf_dir)
    rules = f.nonredundant
    frames = {
        "association pass": f.inputs.assoc_all.groupBy("entity_id", "label_id", "label_name", "status").count(),
        "transactions": transactions.build_transactions(f.pos_train_pairs, f.entities),
        "negative support": contrast.negative_support(f.rules, f.tx_neg, f.n_neg),
        "candidates": discover.label_pairs(discover.dedup_candidates(discover.rule_matches(rules, f.entities)),
                                           f.entities, f.pos_train_pairs, f.pos_test_pairs, f.neg_pairs),
        "containment": containment_join(rules.select("label_id", "antecedent"), "antecedent",
                                        f.entities.select("entity_id", "features"), "features"),
        "bridge evidence": f.with_evidence(f.candidates_dedup),
    }
    out = ["# Physical plans of the key stages", "",
           f"`scripts/dump_plans.py` at {os.path.basename(sf_dir)}, broadcasts off (initial plans, lines cut at "
           f"{WIDTH} characters).", ""]
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```"]
        out += [line[:WIDTH] for line in plan.rstrip().splitlines()] + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    close()
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
