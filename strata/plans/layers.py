"""Bronze -> silver stage runners: contract-driven, gated before the write, evaluated once.

Each runner composes the operators in the same order:

    conform (typed, rejects counted) -> optional derivations -> optional domain filter
    -> latest per key -> write mode (stages the batch once) -> gate on the staged batch
    -> write

Rows are split into good ones and rejects in one staged pass; the reject counters are read
from the staged files, and ``quarantine`` keeps the rejected rows with their reasons. The
gate is one aggregate over the staged batch, and the table is touched only when every rule
passes. A gate failure raises ``RulesBroken`` (exit code 3: do not retry).
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.operators import quality, tables
from strata.operators.conform import split
from strata.operators.contracts import Contract
from strata.operators.latest import latest_by_key
from strata.session import discard


@dataclass
class StageReport:
    table: str
    rejects: dict = field(default_factory=dict)     # counted from the staged split
    quality: list[Row] = field(default_factory=list)
    rewritten: int = 0                              # partitions / slices rewritten (-1: whole table)


def _write(bronze: DataFrame, contract: Contract, keep: Sequence[str], derive: Callable[[DataFrame], DataFrame] | None,
           domain: Column | None, quarantine: str | None, report: StageReport, write: Callable[[DataFrame], int]) -> StageReport:
    """Split the batch, write its good rows, then keep its rejects (appended to the folder
    ``quarantine``, if one is named); a failed write keeps neither."""
    parts = split(bronze, contract, keep, derive, domain)
    try:
        report.rejects = parts.ledger().first().asDict()
        report.rewritten = write(parts.good)
        if quarantine is not None:
            parts.rejects.withColumn("table", F.lit(report.table)).write.mode("append").parquet(quarantine)
    finally:
        parts.discard()
    return report


def silver_upsert(bronze: DataFrame, contract: Contract, table: str, rules: Sequence[quality.Rule],
                  keep: Sequence[str] = (), order: Sequence[str] | None = None,
                  derive: Callable[[DataFrame], DataFrame] | None = None,
                  domain: Column | None = None, location: str | None = None,
                  log: Callable[[str], None] = print, quarantine: str | None = None,
                  buckets: int | None = None) -> StageReport:
    """Conform, keep the latest row per ``contract.keys``, gate, upsert. Where the ``order``
    columns are stored, the newest row wins over the table's as well: a batch that comes
    late can't roll a key back."""
    report = StageReport(table)

    def write(rows: DataFrame) -> int:
        latest = latest_by_key(rows, list(contract.keys), list(order)) if order else rows
        return tables.upsert(latest, table, list(contract.keys), list(contract.partitions), location,
                             order=list(order) if order and set(order) <= set(rows.columns) else None,
                             unique_keys=bool(order), buckets=buckets, before_write=lambda staged: report.quality.extend(
                                 quality.enforce(staged, rules, stage=table, log=log)))

    return _write(bronze, contract, keep, derive, domain, quarantine, report, write)


def silver_replace(bronze: DataFrame, contract: Contract, table: str, rules: Sequence[quality.Rule],
                   where: Mapping[str, object], keep: Sequence[str] = (),
                   derive: Callable[[DataFrame], DataFrame] | None = None,
                   domain: Column | None = None, location: str | None = None,
                   log: Callable[[str], None] = print, quarantine: str | None = None) -> StageReport:
    """Conform, filter to the domain, gate, replace the slice ``where``.

    For tables without a natural key (every row is a fact): re-running a slice
    replaces it instead of duplicating it."""
    report = StageReport(table)

    def write(rows: DataFrame) -> int:
        return tables.replace_slice(rows, table, where, list(contract.partitions), location,
                                    before_write=lambda staged: report.quality.extend(
                                        quality.enforce(staged, rules, stage=table, log=log)))

    return _write(bronze, contract, keep, derive, domain, quarantine, report, write)


def gold_overwrite(mart: DataFrame, table: str, rules: Sequence[quality.Rule],
                   partitions: Sequence[str] = (), location: str | None = None,
                   log: Callable[[str], None] = print) -> StageReport:
    """Derived (gold) table: compute ``mart`` once (staged), gate the staged copy in one
    aggregate, then fully overwrite ``table`` from it. Nothing is written when a rule
    fails. The upstream scans and joins run once, not once per check and again for
    the write."""
    staged, _, path = tables.staged_at(mart, "gold-stage")
    try:
        report = StageReport(table, quality=quality.enforce(staged, rules, stage=table, log=log))
        tables.overwrite(staged, table, partitions=list(partitions), location=location)
    finally:
        discard(mart.sparkSession, path)
    report.rewritten = -1
    return report
