"""Raw landing writers: put source-shaped files into the raw zone with Spark.

In production the raw zone is filled by whatever fetched the data; these writers
produce the same file shapes from any DataFrame, in parallel, so the readers can be
exercised on real tables at any size:

* ``land_delimited`` — header + separator + charset text, every value a string.
* ``land_json_arrays`` — each document is one JSON array in its own file, under
  ``<key>=<value>/doc=<n>/``. A document holds ``rows_per_doc`` rows at most, so no
  document (and no task) holds an unbounded group, even when one key holds a third
  of all rows, and small keys do not explode into many tiny files.
* ``land_lines`` — one payload per line (JSON or not), partitioned by key folders.
* ``land_documents`` — nested ``results[].series[].{place, serie map}`` documents.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import hash_salt

DOC = "doc"


def land_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = "ISO-8859-1",
                   header: bool = True, partitions: Sequence[str] = ()) -> str:
    """Every column as text, written as header + separator + charset files."""
    strings = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    w = (strings.write.mode("errorifexists").option("header", header).option("sep", sep)
         .option("encoding", encoding))
    if partitions:
        w = w.partitionBy(*partitions)
    w.csv(path)
    return path


def land_json_arrays(df: DataFrame, path: str, keys: Sequence[str], fields: Sequence[str],
                     rows_per_doc: int = 50_000) -> str:
    """One JSON array of ``fields`` objects per (keys, doc) file, of ``rows_per_doc``
    objects at most.

    The rows are first staged by key in files of that many rows; each staged file then
    becomes a document, numbered within its key. The bound holds whatever the rows hold
    (equal rows too), the source plan runs once, and a hot key is many files."""
    from strata.session import discard, workspace

    spark, keys = df.sparkSession, list(keys)
    staged = workspace(spark, "landing-arrays")
    (df.select(*keys, *[c for c in fields if c not in keys]).hint("rebalance", *keys)
     .write.option("maxRecordsPerFile", rows_per_doc).partitionBy(*keys).parquet(staged))
    rows = spark.read.schema(df.select(*keys, *[c for c in fields if c not in keys]).schema).parquet(staged)
    rows = rows.withColumn("__file", F.col("_metadata.file_path"))
    # one row per staged file: numbered per key, then joined back by the file's name
    order = Window.partitionBy(*keys).orderBy("__file")
    files = rows.select(*keys, "__file").distinct().withColumn(DOC, F.row_number().over(order) - 1).select("__file", DOC)
    docs = (rows.join(files, "__file").groupBy(*keys, DOC)
            .agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value")))
    _write_one_file_per_doc(docs, path, keys + [DOC])
    discard(spark, staged)
    return path


def land_lines(df: DataFrame, path: str, payload: Column, partitions: Sequence[str] = (),
               mode: str = "errorifexists") -> str:
    """One payload per line; ``mode="append"`` adds a new delivery's files next to
    earlier ones (what a file-source stream picks up)."""
    out = df.select(*partitions, payload.alias("value"))
    w = out.write.mode(mode)
    if partitions:
        w = w.partitionBy(*partitions)
    w.text(path)
    return path


def land_documents(df: DataFrame, path: str, place_id: Column, place_name: Column,
                   period: Column, value: Column, unit: str, variable: str,
                   places_per_doc: int = 5_000) -> str:
    """Nested documents: each place's ``period -> value`` map inside ``results[0].series``.

    ``df`` must hold one row per (place, period)."""
    from strata.operators.tables import staged_at   # local import: operators build on sources
    from strata.session import discard

    per_place = (df.select(place_id.alias("pid"), place_name.alias("pname"),
                           period.cast("string").alias("k"), value.cast("string").alias("v"))
                 .groupBy("pid", "pname")
                 .agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("serie")))
    per_place, _, places_path = staged_at(per_place, "landing-places")   # computed once: counted, then nested
    n_docs = max(1, math.ceil(per_place.count() / places_per_doc))
    entries = per_place.select(
        hash_salt(n_docs, "pid").alias(DOC),
        F.struct(F.struct(F.col("pid").alias("id"), F.col("pname").alias("name")).alias("place"),
                 F.col("serie")).alias("entry"))
    docs = entries.groupBy(DOC).agg(F.to_json(F.struct(
        F.concat(F.lit(f"{variable}-"), F.col(DOC).cast("string")).alias("id"),
        F.lit(variable).alias("variable"),
        F.lit(unit).alias("unit"),
        F.array(F.struct(F.collect_list("entry").alias("series"))).alias("results"),
    )).alias("value"))
    _write_one_file_per_doc(docs, path, [DOC])
    discard(df.sparkSession, places_path)
    return path


def _write_one_file_per_doc(docs: DataFrame, path: str, folders: Sequence[str]) -> None:
    # Every (folders) combination holds exactly one document row, and hash
    # repartitioning on the same columns sends it to exactly one writer task,
    # so each folder gets exactly one file: one multiLine document per file.
    (docs.repartition(*folders).write.mode("errorifexists")
     .partitionBy(*folders).text(path))
