"""Skew and join-strategy tools.

* ``hot_keys`` — rows per key, top ``n`` (``TakeOrderedAndProject``, no global sort).
* ``heavy_hitters`` — the same from a sketch's candidates and their exact counts.
* ``direct_sum`` — plain grouped sum. Spark already combines map-side
  (``partial_sum``), so a hot key costs one row per map task, not all its rows.
* ``salted_sum`` — two-level aggregate with a deterministic hash salt: the shape to
  use for aggregates that do not combine well, or to spread a hot key's final merge.
* ``salted_join`` — equi-join that spreads detected hot keys, and any key with more rows
  than a bucket should hold, over buckets (hash salt on the fact, replicated dimension
  rows for these keys only), for joins where AQE's skew split cannot apply.
* ``derived_dim`` + ``dim_join`` — fact x dimension with an explicit strategy:
  ``broadcast`` only after the dimension's row count is proven under a bound (else
  falls back to a shuffle join), ``merge`` forces a sort-merge join over a staged
  dimension (so AQE's skew-join split can apply), ``auto`` leaves the choice to AQE,
  which re-plans from runtime sizes.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import hash_salt
from strata.operators.tables import stage, staged_at
from strata.session import path_bytes

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024   # compressed parquet bytes of the staged dimension
BUCKET_ROWS = 1 << 16   # fact rows that one bucket of a salted join should hold at most


def hot_keys(df: DataFrame, key: str, n: int = 5, alias: str = "hot_key") -> DataFrame:
    """The ``n`` keys with most rows, ties broken by key (``hot_key``, ``n_rows``)."""
    counts = df.groupBy(F.col(key).alias(alias)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), F.col(alias)).limit(n)


def heavy_hitters(df: DataFrame, key: str, n: int = 5, alias: str = "hot_key", tracked: int = 1000) -> DataFrame:
    """``hot_keys`` without a shuffle of all keys: the same rows, NULL keys left out.

    A frequency sketch (one partial per task, merged) names up to ``tracked`` candidates,
    and one scan counts exactly these. The answer is complete if the candidates hold all
    rows, or if the n-th exact count is above ``3.5 / m`` of the rows, ``m`` being the sketch's
    table size: a key that the sketch doesn't name has at most so many. Where neither holds
    (flat data), all keys are counted."""
    held = df.where(F.col(key).isNotNull())
    top = held.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {tracked}, {tracked})").alias("top")).first()
    found = [r["item"] for r in top["top"] or []]
    # bounded by ``tracked``
    exact = held.where(F.col(key).isin(found)).groupBy(F.col(key).alias(alias)).agg(F.count(F.lit(1)).alias("n_rows")).collect()
    best = sorted(map(tuple, exact), key=lambda r: (-r[1], r[0]))[:n]
    table_size = 1 << (-(-4 * tracked // 3) - 1).bit_length()
    whole = sum(r["n_rows"] for r in exact) == top["rows"]
    if not whole and (len(best) < n or best[-1][1] * table_size <= 3.5 * top["rows"]):
        return hot_keys(held, key, n, alias)
    return df.sparkSession.createDataFrame(best, T.StructType([T.StructField(alias, df.schema[key].dataType), T.StructField("n_rows", T.LongType())]))


def direct_sum(df: DataFrame, key: str, measure: str, key_alias: str = "k",
               alias: str = "total") -> DataFrame:
    """Sum per key, in the measure's own type, by one partial + final aggregate."""
    return df.groupBy(F.col(key).alias(key_alias)).agg(F.sum(measure).alias(alias))


def salted_sum(df: DataFrame, key: str, measure: str, buckets: int = 16,
               salt_cols: Sequence[str] | None = None, key_alias: str = "k",
               alias: str = "total") -> DataFrame:
    """Sum per key in two levels: (key, salt) partials, then per key.

    The salt hashes row content (``salt_cols``, default all columns), so recomputing
    a lost task reproduces the same buckets. The sum is in the measure's own type: pass
    decimals where the last digit of a double must not depend on the order.
    """
    cols = list(salt_cols or df.columns)
    partial = (df.withColumn("__salt", hash_salt(buckets, *cols))
               .groupBy(F.col(key).alias(key_alias), "__salt")
               .agg(F.sum(measure).alias("__part")))
    return partial.groupBy(key_alias).agg(F.sum("__part").alias(alias))


def derived_dim(df: DataFrame, key: str, described: DataFrame) -> DataFrame:
    """The distinct keys of ``df`` with what ``described`` (one row per key) says of them:
    a dimension cut down to the keys that a fact uses."""
    return df.select(key).distinct().join(described, key)


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def dim_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "inner",
             strategy: str = "auto", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
             max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join ``fact`` to ``dim``. For ``broadcast`` the dimension is staged once (so the
    size check and the join do not both recompute it) and broadcast only when its
    staged copy is within ``max_broadcast_rows`` rows AND ``max_broadcast_bytes`` bytes
    on disk (both measured, not estimated); otherwise, and for ``merge``, a sort-merge
    join over a staged dimension, which AQE's skew-join handling can split when one
    key holds a large share of the fact. The staged dimension stays referenced by the
    returned (lazy) join, so it is left to the checkpoint folder's retention."""
    on = [on] if isinstance(on, str) else list(on)
    if strategy == "broadcast":
        dim, _, path = staged_at(dim, "dim-stage")
        if path_bytes(dim.sparkSession, path) <= max_broadcast_bytes and bounded_rows(dim, max_broadcast_rows):
            dim = F.broadcast(dim)
        else:   # too big to copy to every executor: shuffle both sides instead
            dim = dim.hint("merge")   # already staged: AQE skew-join applies
    elif strategy == "merge":
        # Staged, the dimension is a plain scan, so both join sides get an ordinary
        # shuffle; AQE can then split a hot key's partition (skew join). With the dim
        # still an aggregate whose partitioning the join reuses, AQE cannot split it.
        dim = stage(dim, "dim-stage").hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return fact.join(dim, on=on, how=how)


def detect_hot_keys(fact: DataFrame, key: str, min_share: float = 0.01) -> list:
    """Every key holding at least ``min_share`` of the rows, largest first, ties by key.

    Counting is a partial+final aggregate; at most ``1 / min_share`` keys can reach the
    driver. NULL is never listed: no equi-join matches it."""
    total = fact.count()
    if total == 0:
        return []
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    top = (counts.filter(F.col(key).isNotNull() & (F.col("__n") >= F.lit(total * min_share)))
           .orderBy(F.col("__n").desc(), key).collect())
    return [r[key] for r in top]


def salt_widths(fact: DataFrame, key: str, buckets: int = 16, min_share: float = 0.01) -> tuple[dict, int]:
    """Buckets of each key that needs several, and of NULL.

    A key with ``min_share`` of the rows gets ``buckets``; that or any other key gets more (a
    power of two) where a bucket would hold over ``BUCKET_ROWS`` rows, so that a bucket
    doesn't grow with the table. At most ``1 / min_share + rows / BUCKET_ROWS`` keys reach
    the driver."""
    total, known = fact.agg(F.count(F.lit(1)), F.count(key)).first()

    def width(rows: int, least: int) -> int:
        return max(least, 1 << (-(-rows // BUCKET_ROWS) - 1).bit_length())

    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    large = counts.where((F.col("__n") >= F.lit(total * min_share)) | (F.col("__n") > BUCKET_ROWS)).collect()
    widths = {r[key]: width(r["__n"], buckets if r["__n"] >= total * min_share else 1) for r in large}
    return widths, width(max(1, total - known), buckets)


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", buckets: int = 16,
                hot: Sequence | None = None, salt_cols: Sequence[str] | None = None,
                min_share: float = 0.01) -> DataFrame:
    """Equi-join on one key, spreading hot and large keys over buckets (``salt_widths``).

    Their fact rows get a deterministic hash salt below the key's number of buckets; their
    dimension rows (only those) are replicated once per bucket; everything else joins with
    salt 0. The result equals ``fact.join(dim, key, how)`` for ``inner`` and ``left``
    joins; a dimension of one row per key grows by at most
    ``buckets / min_share + 2 * rows / BUCKET_ROWS`` rows. Rows of a ``left`` join whose key
    is NULL match nothing and are spread too. Keys named by ``hot`` get ``buckets`` each.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    widths, null_width = salt_widths(fact, key, buckets, min_share) if hot is None else (dict.fromkeys(hot, buckets), buckets)
    if not widths and how == "inner":
        return fact.join(dim, key, how)
    width = F.when(F.col(key).isNull(), null_width)
    for w in sorted(set(widths.values())):
        width = width.when(F.col(key).isin([k for k, of in widths.items() if of == w]), w)
    width = width.otherwise(1)
    salted_fact = fact.withColumn("__salt", hash_salt(width, *(salt_cols or fact.columns)))
    spread = F.when(F.col(key).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), width - 1))
    salted_dim = dim.withColumn("__salt", F.explode(spread))
    return salted_fact.join(salted_dim, [key, "__salt"], how).drop("__salt")
