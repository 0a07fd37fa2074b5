"""Execute every registered query and scan its final physical plan for nested-loop / cartesian joins.

usage: python scripts/plan_scan.py [sf_dir] [--no-broadcast]

``--no-broadcast`` shows the plans that large or skewed sides would get.  Python
nodes are flagged in the mining engine's queries only: the training-data
operators may use them.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emergent.plans import register as _register  # noqa: E402
from emergent.session import local_session  # noqa: E402

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def main() -> int:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    if "--no-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    flagged = 0
    for name, q in _register.QUERIES.items():
        df = q(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in BAD if b in plan]
        joins = sorted({w for w in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin") if w in plan})
        print(f"{name:24s} {'FLAG ' + ','.join(hits) if hits else 'clean'}  joins={','.join(joins)}")
        flagged += bool(hits)
    spark.stop()
    return 1 if flagged else 0


if __name__ == "__main__":
    raise SystemExit(main())
