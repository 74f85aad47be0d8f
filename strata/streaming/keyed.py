"""Newest revision per key, kept in Spark's state store.

``newest_to_silver`` streams bronze files into a table that holds one row per key. The
state store keeps each key's newest revision (the greatest by ``order``, ties as
``latest_by_key`` breaks them), so a micro-batch sends on only the keys that it touched, and
its upsert reads only their partitions. The event time is one of the key's columns, so the
watermark bounds the state: a key is forgotten when its event time falls ``delay`` behind
the newest event time that an earlier micro-batch has seen.

The rule for late rows: what is not older than the watermark is merged like any other row;
what is older is refused, and counted (``late_keys``: keys of a micro-batch that came too
late). Rows with a NULL in the key, the event time included, are left out and counted
(``keyless``). What is left out stays in bronze, where a batch upsert of its slice finds it.

The shuffle partitions of the first run are the state's for good; for large states the
session should choose the RocksDB state store.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import quality, tables
from strata.operators.latest import recency


@dataclass(frozen=True)
class Outcome:
    batches: int      # micro-batches with data
    upserted: int     # keys sent on to the table
    late_keys: int    # keys refused as older than the watermark
    keyless: int      # rows with a NULL in the key


def newest_to_silver(spark: SparkSession, bronze_path: str, schema: T.StructType, table: str, keys: Sequence[str],
                     event_time: str, order: Sequence[str], delay: str, checkpoint: str,
                     partitions: Sequence[str] = (), location: str | None = None,
                     derive: Callable[[DataFrame], DataFrame] | None = None, rules: Sequence[quality.Rule] = (),
                     max_bytes_per_trigger: int | None = None, buckets: int | None = None,
                     log: Callable[[str], None] = lambda _: None) -> Outcome:
    """Merge every new bronze file into ``table``. ``event_time`` (a timestamp) must be one
    of ``keys``; ``derive`` may add columns of the key, such as a partition column, to what
    goes to the table."""
    keys, order = list(keys), list(order)
    if event_time not in keys:
        raise ValueError(f"event time {event_time!r} must be one of the keys {keys}: it bounds the state")
    reader = spark.readStream.schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    ranked = recency(schema, keys, order)
    unordered = [f.name for f in schema if f.name not in keys and f.name not in ranked]
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    read = reader.parquet(bronze_path).observe("keyless", F.count_if(~whole).alias("n"))
    rows = read.where(whole).withWatermark(event_time, delay)
    packed = F.struct(*ranked, *unordered)
    newest = F.max_by(packed, F.struct(*ranked)) if unordered else F.max(packed)
    state = rows.groupBy(*keys).agg(newest.alias("newest"))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        changed = batch.select(*keys, "newest.*")
        if derive is not None:
            changed = derive(changed)
        gate = (lambda staged: quality.enforce(staged, rules, stage=f"{table}#{epoch_id}", log=log)) if rules else None
        all_keys = [*keys, *[p for p in partitions if p not in keys]]
        tables.upsert(changed, table, all_keys, list(partitions), location, order=order, unique_keys=True, before_write=gate, buckets=buckets)

    q = state.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    progress = q.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    sent = sum(op["numRowsUpdated"] for p in progress for op in p["stateOperators"])
    keyless = sum(p["observedMetrics"]["keyless"]["n"] for p in progress if "keyless" in p["observedMetrics"])
    return Outcome(sum(p["numInputRows"] > 0 for p in progress), sent, late, keyless)
