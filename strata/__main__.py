"""Command line: run one job and exit with the orchestrator contract (0 / 1 / 3).

    python -m strata bronze --raw DIR --columns A,B,YEAR,... --year-column YEAR --flow EXP
                            --years 2022,2023 [--reprocess 2] --table NAME [--location PATH]
    python -m strata series --raw DIR --fields date,value --series 1,7 --table NAME [--location PATH]
    python -m strata documents --raw DIR --dataset NAME --years 2021,2022 --table NAME [--location PATH]
    python -m strata silver --bronze NAME --contract FILE.json --table NAME [--column year --values 2022,2023]
                            [--location PATH] [--quarantine PATH]
    python -m strata backfill --source DIR --column year --values 2022,2023 --table NAME
    python -m strata gold --source DIR --table NAME [--location PATH]
    python -m strata publish --table NAME --database DB --target NAME --export PATH
    python -m strata inventory --source DIR --tables orders,events,...
    python -m strata probe

This is an application entry point, so it builds (or joins) the session itself; the
library functions it calls only take ``spark``. Exit 3 means a deterministic data
failure (a quality gate stopped the job): retrying will not help.
"""
from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources
from strata.operators import quality, tables
from strata.operators.contracts import Contract
from strata.plans import gold, jobs, layers
from strata.session import discard


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("strata")
    if not SparkSession.getActiveSession():
        builder = builder.config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def listed_years(years: str, reprocess: int = 0) -> list[int]:
    """The years of a run: those listed, and as many before the last as are still revised."""
    listed = {int(y) for y in years.split(",")}
    return sorted(listed | {max(listed) - k for k in range(reprocess + 1)})


def bronze(spark: SparkSession, args, log=print) -> None:
    """Delimited raw files into the (year, flow) slices of one run.

    A row whose year can't be read refuses the run. Each listed year is a slice of its own:
    one without rows fails and keeps what its slice held, and the others are still written."""
    schema = T.StructType([T.StructField(c.strip(), T.StringType()) for c in args.columns.split(",")])
    years = listed_years(args.years, args.reprocess)
    raw = sources.stamp_lineage(sources.read_delimited(spark, args.raw, schema), run_id=jobs.new_run_id())
    rows = raw.withColumns({"year": F.col(args.year_column).try_cast("int"), "flow": F.lit(args.flow)})
    staged, _, path = tables.staged_at(rows.where(F.col("year").isNull() | F.col("year").isin(years)).hint("rebalance", "year"),
                                       "bronze-stage", (), ["year"])
    try:
        found = {r["year"]: r["count"] for r in staged.groupBy("year").count().collect()}
        if None in found:
            raise ValueError(f"{found[None]} row(s) have no readable {args.year_column}; nothing is written")

        def one(year: int) -> None:
            if year not in found:
                raise FileNotFoundError(f"no rows of {year} under {args.raw}; its slice is left as it was")
            tables.replace_slice(staged.where(F.col("year") == year), args.table, {"year": year, "flow": args.flow}, ["year", "flow"], args.location)

        jobs.run_slices([(f"{args.flow} {y}", lambda y=y: one(y)) for y in years], log)
    finally:
        discard(spark, path)


def series(spark: SparkSession, args, log=print) -> None:
    """JSON-array documents under ``raw/series=K/``, appended to bronze with their lineage.

    Each series is a slice: one without rows, or with a document that isn't JSON, fails, and
    the others are still appended."""
    fields = [f.strip() for f in args.fields.split(",")]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    run_id = jobs.new_run_id()
    docs = sources.stamp_lineage(sources.read_json_array(spark, args.raw, schema, {"series": "string"}, keep_corrupt=True), run_id)

    def one(key: str) -> None:
        staged, _, path = tables.staged_at(docs.where(F.col("series") == key), "series-stage")
        try:
            good, bad = sources.split_documents(staged, fields)
            broken, rows = bad.count(), good.count()
            if broken:
                raise ValueError(f"{broken} document(s) of series {key} are not JSON")
            if not rows:
                raise FileNotFoundError(f"no rows of series {key} under {args.raw}")
            tables.append(good, args.table, ["series"], args.location)
            log(f"[series] {args.table}: {rows} rows of {key}")
        finally:
            discard(spark, path)

    jobs.run_slices([(f"series {k}", lambda k=k: one(k)) for k in (x.strip() for x in args.series.split(","))], log)


def documents(spark: SparkSession, args, log=print) -> None:
    """Nested documents of one dataset into its (dataset, year) slices, a year at a time."""
    years = listed_years(args.years)
    docs = sources.stamp_lineage(sources.read_documents(spark, args.raw), jobs.new_run_id())
    flat = sources.explode_series(docs, keep=["unit", "_raw_path", "_run_id", "_ingested_at"])
    rows = flat.withColumns({"dataset": F.lit(args.dataset), "year": F.col("period").try_cast("int")})
    staged, _, path = tables.staged_at(rows.where(F.col("year").isNull() | F.col("year").isin(years)).hint("rebalance", "year"),
                                       "documents-stage", (), ["year"])
    try:
        found = {r["year"]: r["count"] for r in staged.groupBy("year").count().collect()}
        if None in found:
            raise ValueError(f"{found[None]} entries have no readable period; nothing is written")

        def one(year: int) -> None:
            if year not in found:
                raise FileNotFoundError(f"no entries of {year} under {args.raw}; its slice is left as it was")
            tables.replace_slice(staged.where(F.col("year") == year), args.table, {"dataset": args.dataset, "year": year},
                                 ["dataset", "year"], args.location)

        jobs.run_slices([(f"{args.dataset} {y}", lambda y=y: one(y)) for y in years], log)
    finally:
        discard(spark, path)


def silver(spark: SparkSession, args, log=print) -> None:
    """A bronze table to its conformed one, by a contract file whose entry ``rules`` is the
    gate: an upsert by the contract's keys, or, without keys, a slice replace for each value."""
    spec = json.loads(spark.read.option("wholetext", True).text(args.contract).first()[0])
    rules = quality.rules_from(spec.pop("rules", []))
    order, keep = spec.get("order", []), spec.get("extra", [])
    contract = Contract.from_dict(spec)
    bronze_rows = spark.table(args.bronze)
    if not rules:
        raise ValueError("a silver job needs at least one rule")
    if args.column and args.values:
        kind = bronze_rows.schema[args.column].dataType
        values = [r[0] for r in spark.createDataFrame([(v,) for v in args.values.split(",")], "v string").select(F.col("v").cast(kind)).collect()]
    elif contract.keys:
        values = [None]
    else:
        raise ValueError("without keys a silver job needs --column and --values")

    def one(value) -> None:
        rows = bronze_rows if value is None else bronze_rows.where(F.col(args.column) == F.lit(value))
        more = {"keep": keep, "location": args.location, "quarantine": args.quarantine, "log": log}
        if contract.keys:
            report = layers.silver_upsert(rows, contract, args.table, rules, order=order, **more)
        else:
            report = layers.silver_replace(rows, contract, args.table, rules, {args.column: value}, **more)
        log(f"[silver] {args.table}: {report.rejects}")

    jobs.run_slices([(f"{args.table} {'all' if v is None else v}", lambda v=v: one(v)) for v in values], log)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("gold", help="build, gate and overwrite the gold mart")
    g.add_argument("--source", required=True)
    g.add_argument("--table", required=True)
    g.add_argument("--location")
    b = sub.add_parser("bronze", help="land delimited files of some years and one flow into their slices")
    for name in ("raw", "columns", "year-column", "flow", "years", "table"):
        b.add_argument(f"--{name}", required=True)
    b.add_argument("--reprocess", type=int, default=0, help="also the newest N years before the last one listed")
    b.add_argument("--location")
    e = sub.add_parser("series", help="append JSON-array documents of some series")
    for name in ("raw", "fields", "series", "table"):
        e.add_argument(f"--{name}", required=True)
    e.add_argument("--location")
    d = sub.add_parser("documents", help="explode nested documents of a dataset into its yearly slices")
    for name in ("raw", "dataset", "years", "table"):
        d.add_argument(f"--{name}", required=True)
    d.add_argument("--location")
    v = sub.add_parser("silver", help="conform, gate and write a bronze table by a contract file")
    for name in ("bronze", "contract", "table"):
        v.add_argument(f"--{name}", required=True)
    for name in ("column", "values", "location", "quarantine"):
        v.add_argument(f"--{name}")
    f = sub.add_parser("backfill", help="replace listed slices of a table from a parquet folder")
    for name in ("source", "column", "values", "table"):
        f.add_argument(f"--{name}", required=True)
    f.add_argument("--location")
    u = sub.add_parser("publish", help="export a table and publish it in a database")
    for name in ("table", "database", "target", "export"):
        u.add_argument(f"--{name}", required=True)
    inv = sub.add_parser("inventory", help="row count of each expected table")
    inv.add_argument("--source", required=True)
    inv.add_argument("--tables", required=True)
    sub.add_parser("probe", help="write/read check of the shared work folder")
    args = p.parse_args(argv)

    # validate everything before any Spark work
    try:
        jobs.require(vars(args), {k: (lambda v: bool(str(v).strip()))
                                  for k, v in vars(args).items() if k != "cmd" and v is not None}
                     | ({"years": lambda v: all(x.strip().isdigit() for x in v.split(","))} if args.cmd in ("bronze", "documents") else {}))
    except ValueError as exc:
        print(exc, file=sys.stderr)
        return 2

    spark = _session()

    def run():
        if args.cmd in ("bronze", "series", "documents", "silver"):
            {"bronze": bronze, "series": series, "documents": documents, "silver": silver}[args.cmd](spark, args)
        elif args.cmd == "backfill":
            batch = spark.read.parquet(args.source)
            kind = batch.schema[args.column].dataType
            values = [r[0] for r in spark.createDataFrame([(v,) for v in args.values.split(",")], "v string")
                      .select(F.col("v").cast(kind)).collect()]
            jobs.backfill(batch, args.table, args.column, values, [args.column], args.location)
        elif args.cmd == "publish":
            print(tables.publish(spark.table(args.table), args.database, args.target, args.export))
        elif args.cmd == "gold":
            out = gold.refresh_gold(spark, args.source, args.table, args.location)
            print(f"[gold] {args.table}: {out.count()} rows")
        elif args.cmd == "inventory":
            names = [t.strip() for t in args.tables.split(",") if t.strip()]
            src = args.source.rstrip("/")
            for r in tables.inventory(spark, {n: f"{src}/{n}.parquet" for n in names}).collect():
                print(f"{r['table_name']:24s} {r['status']:8s} {'-' if r['n_rows'] is None else r['n_rows']}")
        else:
            if not jobs.write_read_probe(spark):
                raise RuntimeError("write/read probe failed")
            print("[probe] ok")

    return jobs.exit_code(run)


if __name__ == "__main__":
    sys.exit(main())
