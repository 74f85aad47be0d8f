"""Typed conformance with a reject ledger, domain filters and code lookups.

``conform`` returns the typed rows and a ledger DataFrame of reject counts by reason.
Both are lazy plans over the same projection: the ledger is a single aggregate (one
job for every reason, instead of one count job per reason), and ``Conformed.observed``
lets a caller collect the same counts during the write itself via ``observe``.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions import code_lookup
from strata.operators.contracts import Contract
from strata.session import discard, workspace

_FLAG = "__bad_{}"


@dataclass
class Conformed:
    rows: DataFrame
    ledger: DataFrame
    _flagged: DataFrame
    _reasons: list[str]
    _required: list[str]

    def observed(self, name: str = "conform") -> tuple[DataFrame, Observation]:
        """Rows with reject counters attached; read ``obs.get`` after the write action."""
        obs = Observation(name)
        metrics = [F.count(F.lit(1)).alias("total")]
        metrics += [F.count_if(F.col(_FLAG.format(r))).alias(f"bad_{r}") for r in self._reasons]
        flagged = self._flagged.observe(obs, *metrics)
        kept = flagged
        for r in self._required:
            kept = kept.filter(F.col(r).isNotNull())
        return kept.drop(*[_FLAG.format(r) for r in self._reasons]), obs


def conform(df: DataFrame, contract: Contract, keep: Sequence[str] = (),
            ledger_by: Sequence[str] = ()) -> Conformed:
    """Apply ``contract``: rename, convert tolerantly, count failures, drop required NULLs.

    ``keep`` passes extra columns (lineage, partitions) through untouched;
    ``ledger_by`` groups the reject ledger (e.g. per series) — still one aggregate job.
    """
    keep = list(keep)
    clash = sorted(set(keep) & {f.name for f in contract.fields})
    if clash:
        raise ValueError(f"kept columns {clash} collide with contract targets; rename one side")
    flags = [f.conversion_failed().alias(_FLAG.format(f.name)) for f in contract.fields
             if f.type != "string"]
    reasons = [f.name for f in contract.fields if f.type != "string"]
    required = [f.name for f in contract.fields if f.required]
    flagged = df.select(*[F.col(f"`{c}`") for c in keep], *contract.typed_columns(), *flags)

    rows = flagged
    for r in required:
        rows = rows.filter(F.col(r).isNotNull())
    rows = rows.drop(*[_FLAG.format(r) for r in reasons])

    dropped = F.lit(False)
    for r in required:
        dropped = dropped | F.col(r).isNull()
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(_FLAG.format(r))).alias(f"bad_{r}") for r in reasons]
    aggs += [F.count_if(dropped).alias("dropped")]
    # ``dropped`` covers both unparseable and missing (NULL / null-marker) required values
    grouped = flagged.groupBy(*ledger_by) if ledger_by else flagged
    ledger = grouped.agg(*aggs)
    return Conformed(rows, ledger, flagged, reasons, required)


@dataclass
class Split:
    """A batch staged once and split by outcome: every row is in ``good`` or in ``rejects``.

    ``good``: kept and typed columns. ``rejects``: kept columns, ``reasons`` and ``source``
    (the source columns as JSON text). ``ledger(by)`` counts both from the staged files, so
    neither a retried task nor a second reader counts a row twice. ``discard()`` when read."""

    good: DataFrame
    rejects: DataFrame
    path: str
    _staged: DataFrame
    _reasons: list[str]

    def ledger(self, *by: str) -> DataFrame:
        grouped = self._staged.groupBy(*by) if by else self._staged
        return grouped.agg(F.count(F.lit(1)).alias("total"),
                           *[F.count_if(F.array_contains(_REASONS, r)).alias(r) for r in self._reasons],
                           F.count_if(F.col(_OUTCOME) == "reject").alias("dropped"))

    def discard(self) -> None:
        discard(self._staged.sparkSession, self.path)


_OUTCOME, _REASONS, _SOURCE = "__outcome", "__reasons", "__source"


def split(df: DataFrame, contract: Contract, keep: Sequence[str] = (),
          derive: Callable[[DataFrame], DataFrame] | None = None, domain: Column | None = None) -> Split:
    """Apply ``contract`` in one staged pass, with an array of reasons on every row.

    Reasons are ``bad_<field>`` (source text there, typed value not), ``missing_<field>``
    (a required field without a value) and ``out_of_domain`` (``domain`` isn't TRUE, tested
    after ``derive``, which may only add columns). A row is rejected if a required value is
    NULL or it is out of the domain; other reasons stay on good rows, as a later gate's
    evidence."""
    keep = list(keep)
    clash = sorted(set(keep) & {f.name for f in contract.fields})
    if clash:
        raise ValueError(f"kept columns {clash} collide with contract targets; rename one side")
    spark = df.sparkSession
    bad = {f"bad_{f.name}": f.conversion_failed() for f in contract.fields if f.type != "string"}
    missing = {f"missing_{f.name}": f.missing() for f in contract.fields if f.required}
    source = F.to_json(F.struct(*[F.col(f"`{f.source}`").alias(f.source) for f in contract.fields]))
    typed = df.select(*[F.col(f"`{c}`") for c in keep], *contract.typed_columns(), source.alias(_SOURCE),
                      F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in (bad | missing).items()])).alias(_REASONS))
    dropped = F.lit(False)
    for f in contract.fields:
        if f.required:
            dropped = dropped | F.col(f"`{f.name}`").isNull()
    if derive is not None:
        typed = derive(typed)
    reasons = [*bad, *missing]
    if domain is not None:
        # a row without a required value is counted for that alone
        out = ~dropped & ~F.coalesce(domain, F.lit(False))
        typed = typed.withColumn(_REASONS, F.when(out, F.array_append(_REASONS, F.lit("out_of_domain"))).otherwise(F.col(_REASONS)))
        dropped = dropped | F.array_contains(_REASONS, "out_of_domain")
        reasons.append("out_of_domain")
    rows = typed.withColumn(_OUTCOME, F.when(dropped, "reject").otherwise("good"))
    rows = rows.withColumn(_SOURCE, F.when(F.col(_OUTCOME) == "reject", F.col(_SOURCE)))
    path = workspace(spark, "split")
    rows.write.partitionBy(_OUTCOME).parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    good = staged.where(F.col(_OUTCOME) == "good").drop(_OUTCOME, _REASONS, _SOURCE)
    rejects = staged.where(F.col(_OUTCOME) == "reject").select(*keep, F.col(_REASONS).alias("reasons"), F.col(_SOURCE).alias("source"))
    return Split(good, rejects, path, staged, reasons)


def domain_filter(df: DataFrame, predicate: Column,
                  ledger_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Keep rows where ``predicate`` is TRUE; NULL counts as a failure, as in SQL WHERE.

    Returns ``(kept, ledger)`` where the ledger holds ``kept`` and ``dropped`` counts
    computed in one aggregate.
    """
    ok = F.coalesce(predicate, F.lit(False))
    kept = df.filter(ok)
    grouped = df.groupBy(*ledger_by) if ledger_by else df
    ledger = grouped.agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))
    return kept, ledger


def with_code_lookup(df: DataFrame, code_col: str, mapping: Mapping, out: str,
                     prefix_len: int | None = None) -> DataFrame:
    """Add ``out`` = mapping[code] (or mapping[first ``prefix_len`` chars of code]).

    The map is a literal (bounded by the caller's dict), so this is a narrow
    projection — no join, no shuffle. Unknown codes give NULL.
    """
    code = F.col(code_col)
    if prefix_len:
        code = F.substring(code, 1, prefix_len)
    return df.withColumn(out, code_lookup(code, mapping))
