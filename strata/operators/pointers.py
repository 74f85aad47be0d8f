"""Versions of a table's files, and the catalog pointers that choose among them.

A write never touches files that readers may have open: it writes a fresh version folder,
``<table location>/_versions/<id>``, and then moves pointers in the catalog. A partition is
switched by ``ALTER TABLE ... PARTITION ... SET LOCATION``, a new one is added with its
location, one that left is dropped (the tables are external, so its files stay), and an
unpartitioned table is switched by ``ALTER TABLE ... SET LOCATION``. A query that was
planned before a switch goes on reading the folder it was planned on; later ones see the
new folder. Each pointer moves at once; the partitions of one write move one after another.

Tables are therefore read by name: the files under a table's location are its current ones
only until the first switch. ``vacuum`` removes versions that no pointer names any more,
once they are older than the longest query.

Partition values never pass through Python types: they are compared in Spark, in the
table's own types, and reach the statements as Spark writes them.
"""
from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "_versions"
_VERSION = re.compile(rf"/{VERSIONS}/[0-9a-f]{{32}}/?$")
#: Where the files of a staged partition are; chosen not to be a partition's name.
AT = "__partition_folder"
_DEFAULT = "__HIVE_DEFAULT_PARTITION__"


def text_literal(v: str | None) -> str:
    """A SQL string literal, or NULL."""
    return "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_location(spark: SparkSession, name: str) -> str:
    """The folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return unquote(rows[-1]["data_type"]).rstrip("/")


def new_version(location: str) -> str:
    """A fresh version folder of a table at ``location``."""
    return f"{location.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_version(spark: SparkSession, path: str) -> bool:
    """Delete a version folder that no pointer names (a refused batch's)."""
    if not _VERSION.search(path) or "/.." in path:
        raise ValueError(f"refusing to delete {path!r}: not a version folder")
    fs, p = _file_system(spark, path)
    return bool(fs.delete(p, True))


def listed(spark: SparkSession, name: str, parts: Sequence[str]) -> DataFrame:
    """The table's partitions from the catalog, in the table's types; no file is read."""
    types = {f.name: f.dataType for f in spark.table(name).schema}
    rows = []
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = [unquote(p.split("=", 1)[1]) for p in r[0].split("/")]
        rows.append(tuple(None if v == _DEFAULT else v for v in values))
    text = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in parts]))
    return text.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in parts])


def staged_partitions(staged: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The partitions of a staged version with their folders: one row each."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
    return staged.select(*[F.col(f"`{c}`") for c in parts], folder.alias(AT)).groupBy(*[f"`{c}`" for c in parts]).agg(F.min(AT).alias(AT))


def _same(left: DataFrame, right: DataFrame, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in parts])


def _specs(df: DataFrame, parts: Sequence[str], extra: Sequence[str] = ()) -> list[tuple[str, list]]:
    """Partition values only, as the text of a PARTITION clause."""
    rows = df.select(*[F.col(f"`{c}`").cast("string") for c in parts], *extra).collect()
    return [("(" + ", ".join(f"`{c}` = {text_literal(v)}" for c, v in zip(parts, r)) + ")", list(r[len(parts):])) for r in rows]


def switch_partitions(spark: SparkSession, name: str, parts: Sequence[str], staged: DataFrame, within: Column | None) -> tuple[int, int]:
    """Point every partition of ``staged`` at its folder, and drop the partitions for which
    ``within`` holds and that ``staged`` lacks (None drops none). How many of each."""
    present = staged_partitions(staged, parts)
    found = _specs(present, parts, [AT])
    now = listed(spark, name, parts)
    known = {s for s, _ in _specs(now, parts)}
    gone: list[str] = []
    if within is not None:
        old = now.where(within)
        gone = [s for s, _ in _specs(old.join(present, _same(old, present, parts), "left_anti"), parts)]
    fresh = [f"PARTITION {s} LOCATION {text_literal(unquote(at))}" for s, [at] in found if s not in known]
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(fresh)}")
    for s, [at] in found:
        if s in known:
            spark.sql(f"ALTER TABLE {name} PARTITION {s} SET LOCATION {text_literal(unquote(at))}")
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(f'PARTITION {s}' for s in gone)}")
    spark.catalog.refreshTable(name)
    return len(found), len(gone)


def switch_table(spark: SparkSession, name: str, path: str) -> None:
    """Point an unpartitioned table at another folder."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(path)}")
    spark.catalog.refreshTable(name)


def pointed(spark: SparkSession, name: str, parts: Sequence[str]) -> set[str]:
    """The folders that the table's pointers name."""
    out = {table_location(spark, name)}
    for s, _ in _specs(listed(spark, name, parts), parts) if parts else ():
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION {s}").where("col_name = 'Location'").collect()
        out.add(unquote(rows[0]["data_type"]).rstrip("/"))
    return out


def vacuum(spark: SparkSession, name: str, parts: Sequence[str], older_than_hours: float = 24.0) -> list[str]:
    """Delete version folders that no pointer names and that were written more than
    ``older_than_hours`` ago (longer than any query runs); returns them."""
    used = {_plain(p) for p in pointed(spark, name, parts)}
    location = table_location(spark, name)
    home = location.split(f"/{VERSIONS}/")[0]
    fs, root = _file_system(spark, f"{home}/{VERSIONS}")
    if not fs.exists(root):
        return []
    before, out = (time.time() - older_than_hours * 3600) * 1000, []
    for status in fs.listStatus(root):
        path = _plain(status.getPath().toString())
        if status.getModificationTime() <= before and _VERSION.search(path) and not any(u == path or u.startswith(f"{path}/") for u in used):
            drop_version(spark, status.getPath().toString())
            out.append(path)
    return out


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")
