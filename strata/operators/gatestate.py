"""A gate over a whole partitioned table that reads only what changed.

Beside the table stands a state table with one row per partition: a mark of its files, its
number of rows, and the breaches of every rule. ``gate`` compares the marks of now with the
stored ones (from file names, sizes and times: no column chunk is read), counts the rules in
partitions whose mark is new, drops partitions that are gone, and adds up the stored and the
new counts. The sums are those of a gate over all rows.

Counts of breaches add up over partitions. So do rows beyond one per key, if the key holds
all partition columns, as equal keys then share a partition; a key that doesn't is counted
over the whole table each time. Rules or their bounds changing makes all partitions new.
A custom rule (``counted``) must be a count that adds up, such as ``count_if``.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality, tables
from strata.session import discard

_MARK, _SIGN, _TOTAL, _COUNTS = "__mark", "__rules", "__total", "__breaches"
Report = list[dict]


@dataclass(frozen=True)
class Gate:
    report: Report           # one entry per rule, as ``quality.measure`` has them
    partitions_read: int
    partitions: int

    def enforce(self, stage: str, log: Callable[[str], None] = print) -> None:
        for r in self.report:
            log(json.dumps(r | {"stage": stage}))
        if broken := [quality.Row(**r) for r in self.report if not r["passed"]]:
            raise quality.RulesBroken(stage, broken)


def partition_marks(spark: SparkSession, name: str, parts: Sequence[str]) -> DataFrame:
    """One row per partition that holds rows, with a mark that changes when its files do."""
    m = [F.col(f"_metadata.{c}").alias(f"__{c}") for c in ("file_path", "file_size", "file_modification_time")]
    files = spark.table(name).select(*[f"`{p}`" for p in parts], *m).distinct()
    return files.groupBy(*[f"`{p}`" for p in parts]).agg(
        F.bit_xor(F.xxhash64("__file_path", "__file_size", "__file_modification_time")).alias(_MARK))


def _signature(rules: Sequence[quality.Rule]) -> str:
    said = [(r.kind, r.columns, r.bound, None if r.breaches is None else r.breaches._jc.toString()) for r in rules]
    return hashlib.sha256(json.dumps(said).encode()).hexdigest()


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in columns])


def _counts(df: DataFrame, parts: Sequence[str], rules: Sequence[quality.Rule]) -> DataFrame:
    """Rows and breaches per partition; rules that don't add up count 0 here."""
    by = [F.col(f"`{p}`") for p in parts]
    plain = df.groupBy(*by).agg(F.count(F.lit(1)).alias(_TOTAL), *[
        r.breaches.cast("bigint").alias(f"r{i}") for i, r in enumerate(rules) if r.breaches is not None])
    for i, r in enumerate(rules):
        if r.breaches is None and set(parts) <= set(r.columns):
            keys = df.groupBy(*[f"`{c}`" for c in r.columns]).agg(F.count(F.lit(1)).alias("n"))
            extra = keys.groupBy(*by).agg(F.sum(F.col("n") - 1).alias(f"r{i}"))
            plain = plain.join(extra, _same(plain, extra, parts)).select(*[plain[f"`{c}`"] for c in plain.columns], extra[f"r{i}"])
    have = set(plain.columns)
    return plain.select(*by, _TOTAL, F.array(*[F.col(f"r{i}") if f"r{i}" in have else F.lit(0).cast("bigint") for i in range(len(rules))]).alias(_COUNTS))


def gate(spark: SparkSession, name: str, rules: Sequence[quality.Rule], state: str, location: str | None = None) -> Gate:
    """Measure ``rules`` over table ``name``, with the state in table ``state`` (created at
    ``location`` if it isn't there)."""
    if not rules:
        raise ValueError("no rules to measure")
    parts = tables.partition_columns(spark, name)
    if not parts:
        raise ValueError(f"{name} isn't partitioned: measure it whole")
    sign = _signature(rules)
    # stored once: the marks are compared, and then become the new state's
    marks, _, path = tables.staged_at(partition_marks(spark, name, parts).withColumn(_SIGN, F.lit(sign)), "gate-marks")
    try:
        everything = spark.table(name)
        if tables.table_exists(spark, state):
            old = spark.table(state)
            fresh = marks.join(old, _same(marks, old, [*parts, _MARK, _SIGN]), "left_anti")
            kept = old.join(marks, _same(old, marks, [*parts, _MARK, _SIGN]), "left_semi")
        else:
            fresh, kept = marks, None
        new, all_ = fresh.count(), marks.count()
        rows = everything
        if new < all_:
            # partition values only; a literal predicate is pruned at planning time
            found = fresh.select(*[f"`{p}`" for p in parts]).collect()
            rows = everything.where(reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [
                F.col(f"`{p}`").eqNullSafe(F.lit(v)) for p, v in zip(parts, r)]) for r in found], F.lit(False)))
        counts = _counts(rows, parts, rules)
        measured = fresh.join(counts, _same(fresh, counts, parts)).select(
            *[fresh[f"`{p}`"] for p in parts], fresh[_MARK], fresh[_SIGN], counts[_TOTAL], counts[_COUNTS])
        now = measured if kept is None else kept.select(measured.columns).unionByName(measured)
        if new or kept is None or kept.count() < spark.table(state).count():
            tables.overwrite(now, state, location=location)
        sums = spark.table(state).agg(F.coalesce(F.sum(_TOTAL), F.lit(0)).alias("total"), *[
            F.coalesce(F.sum(F.col(_COUNTS)[i]), F.lit(0)).alias(f"r{i}") for i in range(len(rules))]).first()
    finally:
        discard(spark, path)
    breaches = [sums[f"r{i}"] for i in range(len(rules))]
    whole = [i for i, r in enumerate(rules) if r.breaches is None and not set(parts) <= set(r.columns)]
    for i in whole:
        breaches[i] = quality.measure(everything, [rules[i]]).first()["breaches"]
    report = []
    for r, n in zip(rules, breaches):
        allowed = max(r.allowed_rows, int(sums["total"] * r.allowed_share))
        report.append({"kind": r.kind, "columns": ",".join(r.columns), "bound": r.bound, "breaches": n, "allowed": allowed,
                       "total": sums["total"], "passed": n <= allowed})
    return Gate(report, new, all_)
