"""Bench the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs in a fresh flow (no shared mined state), so its time covers
its whole dependency chain from the parquet scans; results are materialised
with the ``noop`` sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emergent.plans import flow as flow_mod  # noqa: E402
from emergent.plans.register import QUERIES  # noqa: E402
from emergent.session import local_session  # noqa: E402

HEADLINE = [
    "transactions_pos",
    "split_exact",
    "pruned_transactions",
    "label_rules_m2",
    "label_rules_m1",
    "growth_rate",
    "nonredundant_rules",
    "candidates_dedup",
    "bridge_evidence",
    "sweep_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8))
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))
    # JVM / codegen warm-up: the flagship on the smallest data set, untimed.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["candidates_dedup"](spark, warm).write.format("noop").mode("overwrite").save()
    QUERIES["entity_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        flow_mod.close()  # forgets the flow and deletes its tables
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    flow_mod.close()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
