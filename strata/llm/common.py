"""Helpers shared by the text operators: table reads, shared-folder tables, words."""
from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import workspace

#: White space that separates words; every other character belongs to a word.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    # where no package is installed, Python workers look where the driver found this one
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder and read back.

    Cuts the lineage: what follows reads files that every executor can see, so a lost
    executor costs a re-read, never a recomputation of everything before. Zstandard keeps
    the table small, and its buffers are freed with the file; the default codec's direct
    buffers wait for a garbage collection, outside the heap's bound."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def collector_paused() -> Iterator[None]:
    """Also a decorator: no cyclic garbage collection meanwhile. Lists of words by the million
    make it run often and walk all of them; they hold no cycles, and reference counts free
    them as before."""
    running = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if running:
            gc.enable()


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` begins with, for the names of working columns."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def bind(value: Column, body) -> Column:
    """``body(v)`` with ``v`` evaluated once per row: a lambda variable, unlike a column
    reference, can't be inlined into an inner lambda by the optimizer."""
    return F.transform(F.array(value), body)[0]


def with_passing(df: DataFrame, name: str, value: Column, test) -> DataFrame:
    """The rows whose ``value`` passes ``test``, with that value as column ``name``.

    A plain filter would be pushed below the projection and copy a costly expression into
    the condition as often as it is named there; a generator computes it once."""
    return df.withColumn(name, F.explode(F.filter(F.array(value), test)))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters (empty for null text)."""
    empty = F.array().cast("array<string>")
    # only the first and the last part can be empty
    parts = bind(F.split(text, f"[{SPACE}]+"), lambda p: F.slice(
        p, F.when(p[0] == "", 2).otherwise(1),
        F.size(p) - (p[0] == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")))
    return F.when(text.isNull(), empty).otherwise(parts)


def input_partitions(df: DataFrame) -> int:
    """The session's shuffle width: what a cluster operator tunes to the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
