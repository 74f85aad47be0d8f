"""Job-level plumbing: run ids, argument checks, isolated slices, backfills, exit codes.

* ``new_run_id`` — one id shared by every slice of one execution (lineage).
* ``require`` — validate every argument up front, before any slice writes anything.
* ``run_slices`` — run all slices; a failing slice is recorded and the rest continue;
  ``SlicesFailed`` is raised at the end with the per-slice outcomes.
* ``backfill`` — a multi-value slice replace that reads the source ONCE (staged and
  partitioned by the slice column), then replaces each slice from the staged copy,
  isolating failures per slice.
* ``exit_code`` — map a job's exception to the orchestrator contract (0 / 1 / 3).
"""
from __future__ import annotations

import datetime as _dt
import traceback
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import tables
from strata.operators.quality import Outcome
from strata.session import discard, workspace


def new_run_id(prefix: str = "run") -> str:
    """Unique, sortable run id shared by every slice of one execution."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    return f"{prefix}-{stamp}-{uuid.uuid4().hex[:8]}"


def require(args: Mapping[str, object], checks: Mapping[str, Callable[[object], bool]]) -> None:
    """Raise ``ValueError`` listing every invalid or missing argument at once."""
    bad = [k for k, ok in checks.items() if args.get(k) is None or not ok(args.get(k))]
    if bad:
        raise ValueError(f"invalid or missing argument(s): {', '.join(bad)}")


@dataclass(frozen=True)
class SliceResult:
    name: str
    outcome: Outcome
    detail: str = ""


class SlicesFailed(Exception):
    def __init__(self, results: Sequence[SliceResult]):
        self.results = list(results)
        failed = [r for r in self.results if r.outcome != Outcome.OK]
        self.outcome = (Outcome.DATA_QUALITY if all(r.outcome == Outcome.DATA_QUALITY for r in failed)
                        else Outcome.TRANSIENT)
        super().__init__(f"{len(failed)}/{len(self.results)} slice(s) failed: "
                         + "; ".join(f"{r.name}: {r.detail}" for r in failed))


def run_slices(slices: Sequence[tuple[str, Callable[[], object]]],
               log: Callable[[str], None] = print, at_once: int = 1) -> list[SliceResult]:
    """Run every slice; record failures and continue; raise ``SlicesFailed`` at the end.

    ``at_once`` slices run side by side, each in a thread that keeps its own Spark job
    properties; the outcomes come in the order of the slices whatever ends first. Slices of
    one table may run together as long as they share no partition: a write moves only its
    own partitions' pointers, and sets no session conf."""

    def one(name: str, fn: Callable[[], object]) -> SliceResult:
        try:
            fn()
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            log(f"[slice {name}] FAILED {type(exc).__name__}: {exc}")
            return SliceResult(name, Outcome.of(exc), f"{type(exc).__name__}: {exc}")
        log(f"[slice {name}] ok")
        return SliceResult(name, Outcome.OK)

    if at_once > 1:
        with ThreadPoolExecutor(at_once) as pool:
            # each slice starts from the caller's job properties (group, description, pool)
            results = [f.result() for f in [pool.submit(inheritable_thread_target(lambda n=n, fn=fn: one(n, fn))) for n, fn in slices]]
    else:
        results = [one(name, fn) for name, fn in slices]
    if any(r.outcome != Outcome.OK for r in results):
        raise SlicesFailed(results)
    return results


def backfill(batch: DataFrame, table: str, column: str, values: Sequence,
             partitions: Sequence[str] = (), location: str | None = None,
             log: Callable[[str], None] = print, at_once: int = 1) -> list[SliceResult]:
    """Replace slice ``column = v`` for every ``v`` from one staged read of ``batch``,
    ``at_once`` of them side by side.

    Rows whose slice isn't listed, or is NULL, are counted while staging, and their
    presence refuses the whole backfill before any slice is touched."""
    spark = batch.sparkSession
    unlisted = ~F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    # one task per slice value and piece, instead of a file from every task in every slice
    source, m, staged = tables.staged_at(batch.hint("rebalance", column), "backfill-stage",
                                         [F.count_if(unlisted).alias("unlisted")], [column])
    if m["unlisted"]:
        discard(spark, staged)
        raise ValueError(f"{m['unlisted']} row(s) of the batch lie in no listed slice of {column}")
    # each slice reads only its own staged folder (partition pruning)
    slices = [(f"{column}={v}",
               lambda v=v: tables.replace_slice(source.filter(F.col(column) == F.lit(v)), table,
                                                {column: v}, partitions, location))
              for v in values]
    if at_once > 1 and not tables.table_exists(spark, table):
        tables.replace_slice(source.limit(0), table, {column: values[0]}, partitions, location)
    results = run_slices(slices, log, at_once)     # raises (keeping the staged copy) if a slice failed
    discard(spark, staged)
    return results


def exit_code(job: Callable[[], object], log: Callable[[str], None] = print) -> int:
    """Run ``job``; 0 on success, 3 on a data-quality failure (do not retry), else 1."""
    try:
        job()
        return int(Outcome.OK)
    except SlicesFailed as exc:
        log(str(exc))
        return int(exc.outcome)
    except Exception as exc:  # noqa: BLE001
        log("".join(traceback.format_exception_only(type(exc), exc)).strip())
        return int(Outcome.of(exc))


def write_read_probe(spark) -> bool:
    """Environment check: write a one-row table under the shared folder, read it back.
    Proves the session can write where staging and checkpoints will go."""
    path = workspace(spark, "probe")
    spark.range(1).withColumn("ok", F.lit(True)).write.parquet(path)
    return spark.read.parquet(path).filter("ok").count() == 1
