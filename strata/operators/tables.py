"""Repeatable table writes on plain partitioned parquet catalog tables.

Write modes (all re-runnable: applying the same batch once or N times gives the same
table, except ``append`` which keeps every delivery on purpose):

* ``append`` — history-keeping landing zone.
* ``replace_slice`` — make the slice ``col = v AND col IN (...)`` (on a prefix of the
  partition columns) hold exactly the batch. The batch is written once, in the table's
  types, into a fresh version folder; then its partitions' pointers move there, and the
  slice's partitions that it lacks are dropped (see ``pointers``). An empty batch clears
  the slice. Batch rows outside the slice are refused before any pointer moves.
* ``upsert`` — insert-or-replace by business key. Only partitions the batch touches are
  read; one full join by key merges them into a version folder, and the pointers move.
  Where the table is bucketed by its key the join shuffles the batch alone.
* ``overwrite`` — full rebuild of a derived table, by the same pointers.
* ``publish`` — a version folder and a catalog table that points to it.

No write deletes or rewrites files in place, so readers never find a table or a partition
empty or gone. ``vacuum`` removes versions that are no longer pointed to. ``replaceWhere``
is not used: on non-Delta sinks Spark ignores it and overwrites the whole table.
"""
from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import pointers
from strata.operators.latest import recency
from strata.operators.pointers import table_location
from strata.session import conf_override, discard, unique_name, workspace

# ---------------------------------------------------------------- helpers
def sql_literal(v) -> str:
    """A SQL literal for a partition value (strings escaped)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup; no data is read."""
    return spark.catalog.tableExists(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a catalog table, in order."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def create_table(df: DataFrame, name: str, partitions: Sequence[str] = (),
                 location: str | None = None, buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """Create an external parquet table from ``df``, at ``location`` or a folder of its own
    in the warehouse. ``buckets`` is a number and the columns to bucket and sort by."""
    w = df.write.format("parquet").mode("errorifexists").option("path", location or _default_location(df.sparkSession, name))
    if partitions:
        w = w.partitionBy(*partitions)
    if buckets:
        n, cols = buckets
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def _empty_table(spark: SparkSession, name: str, schema: T.StructType, parts: Sequence[str], location: str) -> None:
    """A table without rows or partitions over a folder that may hold versions already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION {pointers.text_literal(location)}")


def _default_location(spark: SparkSession, name: str) -> str:
    plain = name.replace("`", "").replace(".", "/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{plain}-{uuid.uuid4().hex[:12]}"


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """Number and columns of a table's buckets."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in facts:
        return None
    return int(facts["Num Buckets"]), [c.strip().strip("`") for c in facts["Bucket Columns"].strip("[]").split(",")]


def _in_types_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of a table. A value that a type can't hold raises,
    as in any ANSI store."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[F.col(f"`{f.name}`") if have.get(f.name) == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                       for f in schema])


def _changed_by_cast(df: DataFrame, schema: T.StructType, parts: Sequence[str]) -> Column:
    """Rows whose partition value another type can't hold unchanged (a time of day in a date)."""
    have, out = {f.name: f.dataType for f in df.schema}, F.lit(False)
    for f in schema:
        if f.name in parts and have[f.name] != f.dataType:
            c = F.col(f"`{f.name}`")
            out = out | ~c.eqNullSafe(c.cast(f.dataType).cast(have[f.name]))
    return out


def _match(spec: Mapping[str, object]):
    pred = F.lit(True)
    for c, v in spec.items():
        if isinstance(v, (list, tuple, set, frozenset)):
            pred = pred & F.col(c).isin(list(v))
        else:
            pred = pred & (F.col(c) == F.lit(v))
    return pred


# ---------------------------------------------------------------- staging
def stage(df: DataFrame, label: str = "stage", partitions: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` once as parquet under the shared work folder and read it back.

    Use it when a plan would otherwise be evaluated several times (checks, then the
    write): the upstream work runs once, and the lineage is cut, so a lost executor
    re-reads the staged files instead of recomputing the whole upstream plan."""
    return stage_observed(df, label, (), partitions)[0]


def stage_observed(df: DataFrame, label: str, metrics: Sequence, partitions: Sequence[str] = ()):
    """``stage`` that also returns aggregate ``metrics`` computed in the same pass."""
    staged, values, _ = staged_at(df, label, metrics, partitions)
    return staged, values


def staged_at(df: DataFrame, label: str, metrics: Sequence = (), partitions: Sequence[str] = ()):
    """``stage_observed`` that also returns the staging path, for ``discard`` once the
    staged copy has been fully consumed."""
    spark = df.sparkSession
    path = workspace(spark, label)
    obs = None
    src = df
    if metrics:
        obs = Observation(unique_name(label.replace("-", "_")))
        src = df.observe(obs, *metrics)
    w = src.write.mode("errorifexists")
    if partitions:
        w = w.partitionBy(*partitions)
    w.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return staged, (obs.get if obs is not None else {}), path


# ---------------------------------------------------------------- append
def append(df: DataFrame, name: str, partitions: Sequence[str] = (),
           location: str | None = None) -> None:
    """Append a delivery; creates the partitioned table on first use."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        create_table(df, name, partitions, location)
        return
    df.select(*_table_columns(spark, name)).write.insertInto(name)


# ---------------------------------------------------------------- replace slice
def _write_version(df: DataFrame, path: str, partitions: Sequence[str]) -> DataFrame:
    """``df`` written once to a version folder and read back."""
    w = (df.hint("rebalance", *[f"`{c}`" for c in partitions]) if partitions else df).write.mode("errorifexists")
    (w.partitionBy(*partitions) if partitions else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def replace_slice(df: DataFrame, name: str, where: Mapping[str, object],
                  partitions: Sequence[str] = (), location: str | None = None,
                  before_write: Callable[[DataFrame], object] | None = None,
                  before_switch: Callable[[], object] | None = None) -> int:
    """Replace the slice ``where`` (equality or IN per partition column) by ``df``.

    ``where`` must cover a prefix of the table's partition columns. The batch takes the
    table's types before anything else, so its partitions are the table's; a partition
    value that would change on the way (a time of day into a date) is refused.
    ``before_write`` (e.g. a quality gate) runs on the written version and may raise to
    stop the switch; ``before_switch`` runs right before the pointers move. A refused batch
    leaves no table and no files behind. Returns the number of partitions swapped in or
    dropped.
    """
    if not where:
        raise ValueError("replace_slice needs a non-empty slice; use overwrite() for the whole table")
    spark = df.sparkSession
    parts = partition_columns(spark, name) if table_exists(spark, name) else list(partitions)
    if set(where) != set(parts[: len(where)]):
        raise ValueError(f"slice columns {sorted(where)} must be a prefix of partition columns {parts}")
    return _replace(df, name, parts, _match(where), dict(where), location, before_write, before_switch)


def _replace(df: DataFrame, name: str, parts: Sequence[str], within: Column, said: object, location: str | None,
             before_write: Callable | None, before_switch: Callable | None = None) -> int:
    spark = df.sparkSession
    exists = table_exists(spark, name)
    schema = spark.table(name).schema if exists else df.schema
    location = table_location(spark, name) if exists else location or _default_location(spark, name)
    path = pointers.new_version(location)
    if _shape(df.select(*[f"`{c}`" for c in parts])) != _shape_of(schema, parts):
        changed = df.agg(F.count_if(_changed_by_cast(df, schema, parts)).alias("n")).first()["n"]
        if changed:
            raise ValueError(f"{changed} row(s) have partition values that the types of {name} can't hold")
    staged = _write_version(_in_types_of(df, schema), path, parts)
    try:
        # counted from the written files, where no retry can count twice; only partitions outside are read
        outside = staged.where(~F.coalesce(within, F.lit(False))).count()
        if outside:
            raise ValueError(f"batch has {outside} row(s) outside the replaced slice {said}; refusing to write")
        if before_write is not None:
            before_write(staged)
    except Exception:
        pointers.drop_version(spark, path)
        raise
    if not exists:
        _empty_table(spark, name, schema, parts, location)
    try:
        if before_switch is not None:
            before_switch()
        return sum(pointers.switch_partitions(spark, name, parts, staged, within))
    except Exception as exc:
        raise RuntimeError(f"the batch for {name} is written, but not all pointers moved; it is kept at {path!r}: finish with "
                           f"tables.swap_in(spark, {name!r}, {path!r}) or re-run") from exc


def vacuum(spark: SparkSession, name: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete the versions of a table that nothing points to any more."""
    return pointers.vacuum(spark, name, partition_columns(spark, name), older_than_hours)


# ---------------------------------------------------------------- upsert
def check_keys(df: DataFrame, keys: Sequence[str], unique: bool = True) -> int:
    """Refuse NULL and (``unique``) duplicate business keys, by one aggregate; returns the
    number of rows."""
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys], F.lit(False))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null).alias("nulls"),
                 *([F.count_distinct(F.struct(*[f"`{k}`" for k in keys])).alias("distinct")] if unique else [])).first()
    if row["nulls"]:
        raise ValueError(f"{row['nulls']} batch row(s) have a NULL in key {list(keys)}")
    if unique and row["distinct"] != row["n"]:
        raise ValueError(f"{row['n'] - row['distinct']} duplicate key(s) in batch on {list(keys)}; "
                         "deduplicate (latest_by_key) first")
    return row["n"]


def upsert(df: DataFrame, name: str, keys: Sequence[str], partitions: Sequence[str] = (),
           location: str | None = None, order: Sequence[str] | None = None,
           before_write: Callable[[DataFrame], object] | None = None, unique_keys: bool = False,
           buckets: int | None = None) -> int:
    """Insert new keys, replace existing ones; never deletes. Returns the number of
    partitions rewritten (-1 when the table was created, 0 for an empty batch).

    Without ``order`` a batch row always replaces the stored row (MERGE semantics).
    With ``order`` (recency columns stored in the table) the newer row wins, so
    batches that arrive out of order cannot roll a key back. ``before_write`` (e.g. a
    quality gate) runs on the staged batch and may raise to stop the write; a refused
    batch leaves no staged copy. ``unique_keys`` declares the batch deduplicated on its
    keys (by ``latest_by_key``), which saves the check's shuffle. ``buckets`` creates the
    table bucketed by the key columns that aren't partition columns: later merges then
    shuffle the batch into these buckets and leave the table where it is.
    """
    spark = df.sparkSession
    keys = list(keys)
    exists = table_exists(spark, name)
    parts = partition_columns(spark, name) if exists else list(partitions)
    if exists and not set(parts) <= set(keys):
        raise ValueError(f"partition columns {parts} must be part of the key {keys}: "
                         "otherwise a key could move partition and leave its old row behind")
    if exists:
        df = _in_types_of(df, spark.table(name).schema)
    # Evaluate the batch once: the key check, the touched partitions and the merge all read
    # the staged copy.
    df, _, batch_path = staged_at(df, "upsert-batch")
    try:
        n = check_keys(df, keys, unique=not unique_keys)
        if before_write is not None:
            before_write(df)
        if not exists:
            by = [k for k in keys if k not in parts]
            create_table(df.hint("rebalance", *parts) if parts and not buckets else df, name, parts, location,
                         (buckets, by) if buckets and by else None)
            return -1
        return _merge(spark, df, name, keys, parts, order) if n else 0
    finally:
        discard(spark, batch_path)


def merged_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """One row per key of two frames that hold each key once: the batch's row, or with
    ``order`` the newer one (ties as ``latest_by_key`` breaks them). One full join, so a side
    that is already dealt out by the key isn't shuffled."""
    cols = target.columns
    rest = [c for c in cols if c not in keys]
    mine, theirs = (next(n for n in (f"{x}_", f"{x}__", f"{x}___") if n not in cols) for x in ("batch", "target"))

    def packed(df: DataFrame, as_: str) -> DataFrame:
        return df.select(*[f"`{k}`" for k in keys], F.struct(F.lit(True).alias("there"), *[F.col(f"`{c}`") for c in rest]).alias(as_))

    joined = packed(target, theirs).join(packed(batch, mine), list(keys), "full_outer")
    wins = F.col(f"{theirs}.there").isNull()
    if order:
        ranked = [c for c in recency(target.schema, keys, order) if c in rest]
        key = lambda side: F.struct(*[F.col(f"{side}.`{c}`") for c in ranked])
        wins = wins | (F.col(f"{mine}.there").isNotNull() & (key(mine) >= key(theirs)) if ranked else F.col(f"{mine}.there").isNotNull())
    else:
        wins = wins | F.col(f"{mine}.there").isNotNull()
    return joined.select(*[F.col(f"`{c}`") if c in keys else F.when(wins, F.col(f"{mine}.`{c}`")).otherwise(F.col(f"{theirs}.`{c}`")).alias(c)
                           for c in cols])


def _merge(spark: SparkSession, batch: DataFrame, name: str, keys: list[str], parts: list[str], order: Sequence[str] | None) -> int:
    target = spark.table(name)
    if parts:
        # a literal predicate on the partition columns is pruned at planning time; values only
        found = batch.select(*[f"`{c}`" for c in parts]).distinct().collect()
        by_prefix: dict[tuple, list] = {}
        for r in found:
            by_prefix.setdefault(tuple(r)[:-1], []).append(r[-1])
        target = target.filter(reduce(lambda a, b: a | b, [
            _match({**dict(zip(parts, p)), parts[-1]: v}) for p, v in by_prefix.items()]))
    merged = merged_rows(batch.select(*[f"`{c}`" for c in target.columns]), target, keys, order)
    path = pointers.new_version(table_location(spark, name).split(f"/{pointers.VERSIONS}/")[0])
    layout = bucketing(spark, name)
    if layout:
        # files of a version are bucketed like the table's; only a table's writer does that
        helper = unique_name("merge")
        try:
            with conf_override(spark, CO_LOCATED):
                create_table(merged, helper, parts, path, layout)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {helper}")   # external: the files stay
    else:
        _write_version(merged, path, parts)
    try:
        return swap_in(spark, name, path)
    except Exception as exc:
        raise RuntimeError(f"upsert into {name}: the merged rows are written, but not all pointers moved; they are kept "
                           f"at {path!r}: finish with tables.swap_in(spark, {name!r}, {path!r}) "
                           "or re-run the upsert") from exc


#: A bucketed side meets the join's needs by its bucket columns alone (the other key columns
#: are partition columns), so that only the other side moves.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true"}


def swap_in(spark: SparkSession, name: str, version: str) -> int:
    """Point the table's partitions at those of a version folder, the whole table if it is
    unpartitioned; returns how many."""
    parts = partition_columns(spark, name)
    if not parts:
        pointers.switch_table(spark, name, version)
        return 1
    # the table's schema: partition types must not be re-inferred from folder names
    staged = spark.read.schema(spark.table(name).schema).parquet(version)
    return pointers.switch_partitions(spark, name, parts, staged, None)[0]


# ---------------------------------------------------------------- overwrite / publish
def overwrite(df: DataFrame, name: str, partitions: Sequence[str] = (),
              location: str | None = None, before_switch: Callable[[], object] | None = None) -> None:
    """Full rebuild of a derived table (drops partitions the new data lacks).

    An existing table of the same columns keeps its old rows readable until the new
    version is complete, then its pointers move. Another shape needs a new table."""
    spark = df.sparkSession
    if table_exists(spark, name) and _shape(spark.table(name)) == _shape(df.select(*[f"`{c}`" for c in spark.table(name).columns if c in df.columns])) \
            and len(df.columns) == len(spark.table(name).columns) and partition_columns(spark, name) == list(partitions):
        if partitions:
            _replace(df, name, list(partitions), F.lit(True), "the whole table", None, None, before_switch)
            return
        path = pointers.new_version(table_location(spark, name).split(f"/{pointers.VERSIONS}/")[0])
        _write_version(df.select(*[f"`{c}`" for c in spark.table(name).columns]), path, ())
        if before_switch is not None:
            before_switch()
        pointers.switch_table(spark, name, path)
        return
    w = df.write.format("parquet").mode("overwrite").option("path", location or _default_location(spark, name))
    (w.partitionBy(*partitions) if partitions else w).saveAsTable(name)


def _shape(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema]


def _shape_of(schema: T.StructType, columns: Sequence[str]) -> list[tuple]:
    return [(c, schema[c].dataType) for c in columns]


def publish(df: DataFrame, database: str, table: str, export_path: str,
            database_location: str | None = None, single_file: bool = False,
            before_switch: Callable[[], object] | None = None) -> str:
    """Make ``database.table`` hold ``df``: one copy, written beside ``export_path`` as a
    version, to which the table's pointer then moves.

    Queries that began before the switch read the old version to its end, and no query
    finds the table missing or empty. New columns behind the old ones are added to the table
    first (the old rows show NULL there for a moment); any other change of shape replaces
    the table, the one case with a gap. ``single_file`` also exports one file at
    ``export_path`` (written by one task: for a mart that a person downloads).
    ``before_switch`` runs when the version is complete and the table still the old one.
    """
    spark = df.sparkSession
    version = pointers.new_version(f"{export_path.rstrip('/')}-table")
    df.write.mode("errorifexists").parquet(version)
    if single_file:
        spark.read.schema(df.schema).parquet(version).coalesce(1).write.mode("overwrite").parquet(export_path)
    loc = f" LOCATION {sql_literal(database_location)}" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    full = f"`{database}`.`{table}`"
    if before_switch is not None:
        before_switch()
    if table_exists(spark, full):
        old, new = _shape(spark.table(full)), _shape(df)
        if new[:len(old)] == old:
            added = ", ".join(f"`{n}` {t.simpleString()}" for n, t in new[len(old):])
            if added:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({added})")
            pointers.switch_table(spark, full, version)
            return full
        spark.sql(f"DROP TABLE {full}")
    spark.catalog.createTable(full, version, "parquet", schema=df.schema)
    return full


def publish_if_configured(df: DataFrame, target: Mapping[str, str] | None,
                          log: Callable[[str], None] = print) -> str | None:
    """Publish only when a target is configured; otherwise skip (a success, not an error).

    ``target`` holds ``database``, ``table``, ``export_path`` and optionally
    ``database_location``."""
    if not target or not target.get("database"):
        log("[publish] no target configured: skipped")
        return None
    return publish(df, target["database"], target["table"], target["export_path"],
                   target.get("database_location"))


#: Aggregates that Parquet footers answer: counts, and bounds of numbers and dates.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def from_footers(spark: SparkSession, path: str, *aggregates: Column, explain: bool = False):
    """A row of ``count``, ``min`` and ``max`` over a parquet folder, from its files' footers:
    no column chunk is read. Other aggregates, and columns without exact bounds (strings,
    timestamps), are computed from the rows as usual. ``explain`` returns the plan's text too."""
    with conf_override(spark, FOOTERS):
        df = spark.read.parquet(path).agg(*aggregates)
        row = df.first()
        return (row, df._jdf.queryExecution().executedPlan().toString()) if explain else row


def inventory(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Row count per expected table; a missing one is reported, not raised.

    ``tables`` maps a display name to a catalog table or a parquet path; a path's rows are
    counted from its files' footers."""
    rows = []
    for label, ref in tables.items():
        try:
            n = from_footers(spark, ref, F.count(F.lit(1)))[0] if "/" in ref else spark.table(ref).count()
            rows.append((label, n, "ok"))
        except AnalysisException:
            rows.append((label, None, "missing"))
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, status string")
