"""Bench: the nine tuning measurements plus the headline queries, interleaved in rounds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}; ``queries`` holds medians.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import bench  # noqa: E402
from strata.plans.queries import REGISTRY  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = ["star_join_gold", "latest_per_key", "quality_gate_report", "upsert_latest",
            "typed_conform", "nested_document_explode", "hot_keys_top5"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="strata-bench")
    if warning := bench.volume_warning(spark, sf_dir):
        print(f"WARNING: {warning}", file=sys.stderr)
    t0 = time.perf_counter()
    # headline queries include their writes (landing, upsert, gated overwrite)
    found = bench.compare(spark, sf_dir, bench.variants() | {name: ({}, REGISTRY[name]) for name in HEADLINE})
    results = {name: f["median"] for name, f in found.items()}
    total = round(sum(results.values()), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_medians", "value": total, "unit": "sec",
                      "queries": results, "spread": {n: f["spread"] for n, f in found.items()}, "sf": float(m.group(1)) if m else sf_dir,
                      "wall_sec": round(time.perf_counter() - t0, 2), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
