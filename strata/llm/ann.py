"""Approximate nearest neighbours by collision counting over sorted projections.

Base vectors are dealt into blocks by a hash of the row, queries into blocks of their
own; each (base block, query block) pair is one group of bounded size. Inside a block every
distinct vector is projected on ``PROJECTIONS`` random lines, and each line keeps its
projections in sorted order. A query opens a window around its own projection on every
line and widens all windows round by round (virtual rehashing: width ``WIDTH`` times the
radius, the radius growing by ``RATIO``); the sorted arrays are only read outwards. A
vector that falls into ``THRESHOLD`` of the windows or more is verified: its exact distance
is computed. A query ends when enough verified neighbours lie within the radius, or when
its windows hold the whole block, so every query finds all of a small block.

The nearest of each block are merged by a window over the query. There is no cap on
candidates. Equal vectors are projected and verified once a block, whatever their number,
and equal queries are searched once a block; the ids of a vector's copies are listed up to
the number of neighbours asked for, plus one for the query itself, which loses nothing.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component
take no part, neither do rows without an id; very large and very small components are
measured as others are (a distance beyond the largest double is ``inf``); vectors are only compared with those of the
same dimension; ties go to the smaller id; repeated rows of an id are neighbours each;
repeated query rows (id and vector) are one query, and an id with several vectors is
answered, ranks from 1, for each of them;
a query without candidates gives no row; extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEIGHBOURS = 10
PROJECTIONS = 48
#: Lines whose window must hold a vector before it is verified.
THRESHOLD = 27
RATIO = 1.25
WIDTH = 2.0
SEED = 11
BLOCK_ROWS = 8192
QUERY_ROWS = 4096


def exponent(vectors: np.ndarray) -> int:
    """The power of two just above every component."""
    return int(np.frexp(np.abs(vectors).max(initial=0.0))[1])


def euclidean(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances whose squares neither overflow nor vanish: each difference is scaled by a
    power of two, which changes no digit of the others."""
    # halves: the difference of two finite numbers may be too large itself
    halved = int(max(exponent(vectors), exponent(query)) > 1000)
    gap = vectors * 0.5 - query * 0.5 if halved else vectors - query
    power = np.frexp(np.abs(gap).max(axis=1, initial=0.0))[1]
    gap = np.ldexp(gap, -power[:, None])
    with np.errstate(over="ignore"):
        # inf only where the distance itself has no double
        return np.ldexp(np.sqrt(np.einsum("ij,ij->i", gap, gap)), power + halved)


class CollisionIndex:
    """Sorted projections of distinct vectors, scaled by ``2 ** -power``."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = SEED, power: int | None = None):
        self.vectors = vectors
        self.power = exponent(vectors) if power is None else power
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        at = np.ldexp(vectors, -self.power) @ self.lines
        self.order = np.argsort(at, axis=0, kind="stable").T.copy()
        ordered = np.take_along_axis(at, self.order.T, axis=0).T
        spread = float(np.ptp(ordered)) if len(vectors) else 0.0
        self.first_radius = max(spread / 64, 1e-12)
        # all lines in one ascending array, each shifted beyond the one before
        self.shift = np.arange(projections) * (4 * spread + 1.0)
        self.edges = (float(ordered.min()), float(ordered.max())) if len(vectors) else (0.0, 0.0)
        self.flat = (ordered + self.shift[:, None]).ravel()

    def _places(self, at: np.ndarray, side: str) -> np.ndarray:
        """Where ``at`` would stand on each line."""
        inside = np.clip(at, self.edges[0] - 1e-9, self.edges[1] + 1e-9)
        places = np.searchsorted(self.flat, inside + self.shift, side)
        return places - np.arange(len(self.shift)) * len(self.vectors)

    def search(self, query: np.ndarray, enough, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """Verified vectors and their distances; ``enough(vectors, distances, radius)``
        tells whether the search may end."""
        n, lines = len(self.vectors), len(self.shift)
        at = np.ldexp(query, -self.power) @ self.lines
        low = high = self._places(at, "left")
        hits = np.zeros(n, np.int64)
        seen = np.zeros(n, bool)
        found, distances = np.zeros(0, np.int64), np.zeros(0)
        radius = self.first_radius
        while True:
            half = WIDTH * radius / 2
            new_low = np.minimum(self._places(at - half, "left"), low)
            new_high = np.maximum(self._places(at + half, "right"), high)
            fresh = [o[a:b] for o, a, b in zip(self.order, new_low, low)] + [
                o[a:b] for o, a, b in zip(self.order, high, new_high)]
            hits += np.bincount(np.concatenate(fresh), minlength=n)
            low, high = new_low, new_high
            passed = np.flatnonzero((hits >= min(threshold, lines)) & ~seen)
            if len(passed):
                seen[passed] = True
                found = np.concatenate([found, passed])
                distances = np.concatenate([distances, euclidean(self.vectors[passed], query)])
            with np.errstate(over="ignore"):
                reached = np.ldexp(radius, self.power)
            if seen.all() or enough(found, distances, reached):
                return found, distances
            radius *= RATIO


def _unique(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, and the sorted ids of each."""
    if not len(ids):
        return vectors, []
    distinct, which = np.unique(vectors, axis=0, return_inverse=True)
    which = which.ravel()
    order = np.lexsort((ids, which))
    cuts = np.flatnonzero(np.diff(which[order])) + 1
    return distinct, np.split(ids[order], cuts)


def search_block(base_ids: np.ndarray, base: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 neighbours: int = NEIGHBOURS) -> tuple[list[int], list[int], list[float], list[int]]:
    """The nearest of one block for each distinct query: query ids, vector ids, distances,
    hashes of the query vectors."""
    out: tuple[list[int], list[int], list[float], list[int]] = ([], [], [], [])
    vectors, members = _unique(base_ids, base)
    if not len(members):
        return out
    # one scale for both sides, so that no projection overflows
    index = CollisionIndex(vectors, power=max(exponent(vectors), exponent(queries)))
    # a query may be a member itself: one more is enough
    members = [m[:neighbours + 1] for m in members]
    sizes = np.array([len(m) for m in members])
    asked, askers = _unique(query_ids, queries)
    for query, names in zip(asked, askers):
        def enough(found, distances, radius):
            return sizes[found[distances <= radius]].sum() > neighbours

        found, distances = index.search(query, enough)
        # all vectors within the distance at which neighbours + 1 rows are reached
        order = np.argsort(distances, kind="stable")
        reach = np.searchsorted(np.cumsum(sizes[found[order]]), neighbours + 1)
        near = order[distances[order] <= distances[order[min(reach, len(order) - 1)]]]
        rows = sorted((float(distances[k]), int(i)) for k in near for i in members[found[k]])
        asks = xxhash.xxh3_64_intdigest(query.tobytes()) - (1 << 63)
        for name in np.unique(names):
            mine = [(d, i) for d, i in rows if i != name][:neighbours]
            out[0].extend([int(name)] * len(mine))
            out[1].extend(i for _, i in mine)
            out[2].extend(d for d, _ in mine)
            out[3].extend([asks] * len(mine))
    return out


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(finite & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector"), F.size(v).alias("dim"))


def _matrix(t: pa.Table) -> np.ndarray:
    column = t.column("vector").combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def nearest(base: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, id_col: str = "vec_id",
            vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``neighbours`` nearest base rows of each query: query_id, rank, vec_id, score."""
    base, queries = _usable(base, id_col, vector_col), _usable(queries, id_col, vector_col)
    # one kind of zero, so that equal queries meet in a block
    queries = queries.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    base_blocks = max(1, -(-base.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))

    b = dealt(base, "bb", base_blocks, "qb", query_blocks).groupBy("dim", "bb", "qb")
    q = dealt(queries, "qb", query_blocks, "bb", base_blocks).groupBy("dim", "bb", "qb")

    def block(base_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        if not len(base_rows) or not len(query_rows):
            found = ([], [], [], [])
        else:
            found = search_block(np.asarray(base_rows.column("id")), _matrix(base_rows),
                                 np.asarray(query_rows.column("id")), _matrix(query_rows), neighbours)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64()), "asks": pa.array(found[3], pa.int64())})

    found = b.cogroup(q).applyInArrow(block, "query_id long, vec_id long, score double, asks long")
    order = Window.partitionBy("query_id", "asks").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select(
        "query_id", "rank", "vec_id", "score")
