"""Incremental raw -> bronze -> silver with Structured Streaming, run as batch jobs.

* ``land_to_bronze`` — file-source stream over the raw folder, appended to a bronze
  parquet folder with ``trigger(availableNow=True)``: every file that arrived since
  the last run is processed exactly once (tracked in the checkpoint), then the query
  stops. Re-running with no new files adds nothing.
* ``bronze_to_silver`` — file-source stream over bronze; each micro-batch is conformed,
  reduced to the latest row per key, and upserted into the silver table inside
  ``foreachBatch`` with an order-aware upsert, so a late micro-batch carrying an
  older revision cannot roll a key back. A failed micro-batch is retried from the
  checkpoint; the upsert is idempotent, so a replay gives the same table.

Checkpoints live under the shared work folder, never on a machine-local disk.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import quality, tables
from strata.operators.conform import conform
from strata.operators.contracts import Contract
from strata.operators.latest import latest_by_key


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The id of the last committed micro-batch of a checkpoint; -1 before the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def _run(spark: SparkSession, writer, checkpoint: str, path: str | None = None) -> int:
    """Process what is new, and return how many micro-batches that took."""
    before = _last_batch(spark, checkpoint)
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(*[path] if path else [])
    q.awaitTermination()
    return _last_batch(spark, checkpoint) - before


def land_to_bronze(spark: SparkSession, raw_path: str, schema: T.StructType, bronze_path: str,
                   checkpoint: str, partitions: Sequence[str] = (),
                   max_bytes_per_trigger: int | None = None, quarantine: str | None = None) -> int:
    """Process every new raw file of JSON lines once; returns the number of micro-batches.

    Lines that don't parse into the schema go to ``quarantine`` (default: a folder beside
    bronze) as raw text in ``payload``. Each sink is a stream with a checkpoint of its own,
    so both are written exactly once."""
    lines = spark.readStream
    if max_bytes_per_trigger:
        lines = lines.option("maxBytesPerTrigger", max_bytes_per_trigger)
    lines = lines.text(raw_path).where(F.length(F.trim("value")) > 0)
    bad = "_unparsed"
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = lines.select("value", F.from_json("value", full, {"columnNameOfCorruptRecord": bad}).alias("r"))
    unread = F.col("r").isNull() | F.col(f"r.{bad}").isNotNull()
    good = parsed.where(~unread).select(*[F.col(f"r.{f}").alias(f) for f in schema.fieldNames()]).writeStream.format("parquet")
    if partitions:
        good = good.partitionBy(*partitions)
    rejected = parsed.where(unread).select(F.col("value").alias("payload")).writeStream.format("parquet")
    _run(spark, rejected, f"{checkpoint}-quarantine", quarantine or f"{bronze_path}-quarantine")
    return _run(spark, good, checkpoint, bronze_path)


def bronze_to_silver(spark: SparkSession, bronze_path: str, bronze_schema: T.StructType,
                     contract: Contract, keep: Sequence[str], table: str, order: Sequence[str],
                     checkpoint: str, location: str | None = None,
                     max_bytes_per_trigger: int | None = None,
                     derive: Callable[[DataFrame], DataFrame] | None = None,
                     rules: Sequence[quality.Rule] = (),
                     log: Callable[[str], None] = lambda _: None) -> int:
    """Conform (+ ``derive``) + latest-per-key + order-aware upsert for every new bronze
    file. With ``rules``, each micro-batch is gated before it is written: a failing
    gate stops the stream with its offsets uncommitted, so the same files are retried
    on the next run (once the data is fixed), never half-applied."""
    keys, parts = list(contract.keys), list(contract.partitions)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        rows = conform(batch, contract, keep=keep).rows
        if derive is not None:
            rows = derive(rows)
        latest = latest_by_key(rows, keys, list(order))
        gate = (lambda staged: quality.enforce(staged, rules, stage=f"{table}#{epoch_id}", log=log)) \
            if rules else None
        tables.upsert(latest, table, keys, partitions=parts, location=location, order=order,
                      unique_keys=True, before_write=gate)

    reader = spark.readStream.schema(bronze_schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return _run(spark, reader.parquet(bronze_path).writeStream.foreachBatch(apply), checkpoint)
