"""Latest-wins deduplication: one row per business key, newest by a total order.

Two plans with identical results, both bounded when one key holds a third of all rows:

* ``method="aggregate"`` (default): ``max(struct(order..., tiebreak..., payload...))``
  per key. ``Max`` is combinable, so Spark runs a partial aggregate before the
  shuffle: a hot key leaves each map task as one row. (A struct buffer is not
  fixed-width, so Spark picks a sort-based aggregate; it spills like any sort.)
* ``method="window"``: ``row_number() over (partition by key order by ... desc) = 1``.
  Spark inserts a partial ``WindowGroupLimit`` before the shuffle (and a final one
  after), so the final window also sees at most one row per key per map task.

Project away columns you do not need before calling: every payload column rides
through the shuffle.

Ties on the recency columns are broken by ``tiebreak`` (default: every other column)
so the result is deterministic on re-runs and retries.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PICK = "__latest"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def recency(schema: T.StructType, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """The columns that decide which row of a key is newest: ``order``, then every other
    orderable column."""
    return [*order, *[f.name for f in schema if f.name not in keys and f.name not in order and _orderable(f.dataType)]]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  tiebreak: Sequence[str] | None = None, method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` then ``tiebreak`` (default: every
    other orderable column). Same columns as ``df``."""
    keys, order = list(keys), list(order)
    if not keys or not order:
        raise ValueError("latest_by_key needs at least one key and one order column")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if tiebreak is None:   # every orderable column; maps can only ride along as payload
        tiebreak = [c for c in rest if _orderable(types[c])]
    tiebreak = [c for c in tiebreak if c not in order]
    ranked = order + tiebreak
    payload = [c for c in rest if c not in ranked]

    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in ranked])
        return (df.withColumn("__rn", F.row_number().over(w))
                .filter(F.col("__rn") == 1).drop("__rn").select(*df.columns))
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")

    # Struct ordering compares fields left to right with NULL lowest, which matches
    # ORDER BY ... DESC NULLS LAST picking the first row.
    if all(_orderable(types[c]) for c in payload):
        picked = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *payload)).alias(_PICK))
    else:   # unorderable payload: pick it by the ranked struct (also combinable map-side)
        picked = df.groupBy(*keys).agg(
            F.max_by(F.struct(*ranked, *payload), F.struct(*ranked)).alias(_PICK))
    return picked.select(*keys, *[F.col(f"{_PICK}.{c}").alias(c) for c in ranked + payload]) \
                 .select(*df.columns)
