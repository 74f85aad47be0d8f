"""Skew probe: does any single task receive a hot key's rows?

    python tools/skew_probe.py [sf_dir] [--json]

Builds skewed variants of the driver tables in which ONE key holds a third of all
rows (hot order key, hot supplier, hot customer), runs the operators that group or
join on that key, and reads Spark's event log (written to a fresh scratch folder) to
report, per operator, the most shuffle records read by any single task. If a hot
group were collected into one task, that number would be >= a third of the rows;
with 64 shuffle partitions an even share is about 1/64 of the rows.
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import quality, skew  # noqa: E402
from strata.operators.latest import latest_by_key  # noqa: E402
from strata.operators.tables import stage  # noqa: E402
from strata.plans import gold  # noqa: E402
from strata.session import local_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="strata-eventlog-")
    # coalescing off: each task's count then shows its own share, not merged partitions
    spark = local_session(8, shuffle_partitions=64, app="strata-skew-probe",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 # no broadcasts: at 100 TB dimensions are big, so every
                                 # join is measured as a shuffle join (the worst case)
                                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                                 # skew-join thresholds scaled down to the test data (on a
                                 # cluster: 256 MB, see session.scale_conf)
                                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"})
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    li = gold.load(spark, sf, "lineitem")
    li = li.withColumns({"l_orderkey": F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey")),
                         "l_suppkey": F.when(hot, F.lit(0)).otherwise(F.col("l_suppkey"))})
    # Written as 32 files, like any large table: a skewed shuffle partition can only be
    # split (AQE skew join) at map-output boundaries, and a single small file with 3 row
    # groups would give just 3 map tasks.
    li = stage(li.repartition(32), "skewed-lineitem")
    orders = gold.load(spark, sf, "orders")
    # suppliers with their region's name, and the hot key as one more of the first region
    nations = gold.load(spark, sf, "nation").join(gold.load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = gold.load(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region"))
    regions = regions.where("l_suppkey <> 0").unionByName(
        gold.load(spark, sf, "region").where("r_regionkey = 0").select(F.lit(0).cast("bigint").alias("l_suppkey"), F.col("r_name").alias("region")))
    orders = orders.withColumn("o_custkey", F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0,
                                                   F.lit(0)).otherwise(F.col("o_custkey")))
    customer = gold.load(spark, sf, "customer")
    n_li, n_o = li.count(), orders.count()
    cases = {
        "latest_by_key(aggregate)": (n_li, lambda: latest_by_key(
            li.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"),
            ["l_orderkey", "l_linenumber"], ["l_shipdate"])),
        "latest_by_key(window)": (n_li, lambda: latest_by_key(
            li.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"),
            ["l_orderkey", "l_linenumber"], ["l_shipdate"], method="window")),
        "direct_sum(hot supplier)": (n_li, lambda: skew.direct_sum(li, "l_suppkey", "l_extendedprice")),
        "salted_sum(hot supplier)": (n_li, lambda: skew.salted_sum(
            li, "l_suppkey", "l_extendedprice", 16, ["l_orderkey", "l_linenumber", "l_partkey"])),
        "hot_keys(hot supplier)": (n_li, lambda: skew.hot_keys(li, "l_suppkey")),
        "quality.one_row_per(hot key)": (n_li, lambda: quality.measure(
            li, [quality.one_row_per("l_orderkey", "l_linenumber")])),
        "dim_join(merge, hot supplier)": (n_li, lambda: skew.dim_join(
            li.select("l_suppkey", "l_extendedprice"),
            skew.derived_dim(li, "l_suppkey", regions),
            "l_suppkey", strategy="merge")),
        "salted_join(hot supplier)": (n_li, lambda: skew.salted_join(
            li.select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber"),
            skew.derived_dim(li, "l_suppkey", regions), "l_suppkey",
            buckets=16, salt_cols=["l_orderkey", "l_linenumber"])),
        "gold.exports(hot customer)": (n_o, lambda: gold.exports(orders, customer)),
        "gold.measures(hot order+customer)": (n_li, lambda: gold.measures(li, orders, customer)),
    }
    for name, (_, build) in cases.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group = {}
    max_read = defaultdict(int)
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    group = stage_group.get(ev.get("Stage ID"))
                    if group:
                        max_read[group] = max(max_read[group], read)
    if "--json" in sys.argv:
        print(json.dumps({name: {"rows": n, "hot_rows": n // 3, "max_task_rows": max_read.get(name, 0)}
                          for name, (n, _) in cases.items()}))
        return
    print(f"{'operator':34s} {'rows':>9s} {'hot key rows':>12s} {'max shuffle rows in one task':>29s}")
    for name, (n, _) in cases.items():
        print(f"{name:34s} {n:9d} {n // 3:12d} {max_read.get(name, 0):29d}")


if __name__ == "__main__":
    main()
