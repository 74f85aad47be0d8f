"""Exact top-k inner products by vector-approximation files.

Components become integers, ``floor(SCALE * x)``. Base rows are dealt into blocks by a
hash of the row (about ``BLOCK_VALUES`` components each, and as many blocks as the session
has shuffle partitions at least); each block gets a copy of every query, so queries stand
against all rows block by block and no pair is ever a row. A task reads its block once,
builds the block's approximation file and then streams the queries through it, batch by
batch:

1. *Approximations.* Every dimension is cut into ``2 ** BITS`` cells of equal integer
   width; a vector is stored as one byte a dimension, its cell numbers.
2. *Scan.* With cells of equal width a query's score against a vector lies between
   ``base + cells . step + low`` and ``... + high``, ``low`` and ``high`` being the same for
   all vectors. One matrix product over the cells therefore bounds all scores, and vectors
   whose upper bound is under the k-th best lower bound are out.
3. *Verification.* The exact vectors of the others are read in the order of their bounds,
   until the k-th score is above every bound not yet read.

The best k of each block are merged by a window over the query. All arithmetic is on
integers (in floats only where they are exact), there is no cap on candidates, and equal
vectors are scanned once a block: of a vector's rows, the ids that can reach a list of k are
kept. Memory of a task: one block, one tile of bounds.

Defined cases: rows without an id, and vectors that are null, hold a null or non-finite
component, or one beyond the range of doubles after scaling, take no part; zero vectors do;
empty vectors score 0 with each other; vectors meet only those of the same dimension; ties
go to the smaller id; repeated rows of an id are candidates each; repeated query rows (id
and integer vector) are one query, and an id with several vectors is answered, ranks from 1,
for each; scores beyond the range of long count as its end; a
query without candidates gives no row; empty tables give none; extra columns are ignored.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import input_partitions

NEIGHBOURS = 5
SCALE = 256
BITS = 6
#: Components in one block; bounds a task's memory.
BLOCK_VALUES = 1 << 24
#: Rows and queries of one matrix product.
TILE_ROWS, TILE_QUERIES = 8192, 256
#: Exact vectors read at a time for a query.
READ_ROWS = 32

_EXACT_F32, _EXACT_F64, _LONG = 1 << 24, 1 << 53, (1 << 63) - 1


class ApproximationFile:
    """The distinct integer vectors of a block, their cells, and the ids of each."""

    def __init__(self, ids: np.ndarray, marks: np.ndarray, vectors: np.ndarray, neighbours: int):
        self.k = neighbours
        # rows with equal marks stand together; a mark is a hash, so vectors are compared too
        order = np.lexsort((ids, marks))
        ids, marks, vectors = ids[order], marks[order], vectors[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (marks[1:] != marks[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
        starts = np.flatnonzero(fresh)
        self.vectors = vectors[starts]
        self.ids = [self._enough(x) for x in np.split(ids, starts[1:])]
        # an asker's own id can empty as many vectors as one id has
        most = Counter(int(i) for x in self.ids for i in set(x))
        self.spare = max(most.values(), default=0)
        self.peak = float(np.abs(self.vectors).max(initial=0))
        low, high = (self.vectors.min(axis=0), self.vectors.max(axis=0)) if vectors.shape[1] else (np.zeros(0), np.zeros(0))
        self.low = low
        self.width = np.maximum(1, np.ceil((high - low + 1) / (1 << BITS)))
        self.cells = ((self.vectors - low) // self.width).astype(np.uint8)

    def _enough(self, ids: np.ndarray) -> list[int]:
        """Ids, smallest first, from which k remain without any one of them, if so many are there."""
        out: list[int] = []
        for i in ids.tolist():
            if len(out) < self.k or out[-self.k] != i:
                out.append(i)
                if len(out) == 2 * self.k:
                    break
        return out

    def _candidates(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the vectors that the bounds leave, best bound first, and their
        upper bounds."""
        n, wanted = len(self.vectors), self.k + self.spare
        step = queries * self.width
        slack = np.abs(queries) @ (self.width - 1)
        offset = queries @ self.low + np.maximum(queries, 0) @ (self.width - 1)
        kind = np.float32 if np.abs(step).sum(axis=1).max(initial=0) * (1 << BITS) < _EXACT_F32 else np.float64
        step = step.astype(kind)
        best = np.full((len(queries), wanted), -np.inf)
        kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        for at in range(0, n, TILE_ROWS):
            scan = step @ self.cells[at:at + TILE_ROWS].astype(kind).T
            if scan.shape[1] > wanted:
                top = np.partition(scan, scan.shape[1] - wanted, axis=1)[:, -wanted:]
            else:
                top = scan
            best = np.sort(np.concatenate([best, top], axis=1), axis=1)[:, -wanted:]
            who, row = np.nonzero(scan >= (best[:, 0] - slack)[:, None])
            cuts = np.searchsorted(who, np.arange(1, len(queries)))
            for q, (rows, values) in enumerate(zip(np.split(row, cuts), np.split(scan[who, row], cuts))):
                if len(rows):
                    kept[q].append((rows + at, values.astype(np.float64)))
        out = []
        for q, parts in enumerate(kept):
            rows, values = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(-values, kind="stable")
            order = order[values[order] >= best[q, 0] - slack[q]]
            out.append((rows[order], values[order] + offset[q]))
        return out

    def search(self, queries: np.ndarray) -> Iterator[list[tuple[int, list[int]]]]:
        """For each query the exact scores of all vectors that can matter, with their ids:
        best first, at least k ids besides any one id's own, if there are so many."""
        peak = float(np.abs(queries).max(initial=0))
        wide = 4.0 * (peak + 1) * (self.peak + 1) * max(1, queries.shape[1]) >= _EXACT_F64
        for lo in range(0, len(queries), TILE_QUERIES):
            batch = queries[lo:lo + TILE_QUERIES]
            if wide:
                # beyond the exact doubles bounds say nothing: all vectors are read, as Python integers
                whole = [[int(x) for x in v] for v in self.vectors]
                for q in batch:
                    q = [int(x) for x in q]
                    scores = [max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(q, v)))) for v in whole]
                    yield self._listed(range(len(whole)), scores)
                continue
            for q, (rows, bounds) in zip(batch, self._candidates(batch)):
                yield self._read(q, rows, bounds)

    def _read(self, query: np.ndarray, rows: np.ndarray, bounds: np.ndarray) -> list[tuple[int, list[int]]]:
        scores = np.zeros(0)
        wanted = self.k + self.spare
        for at in range(0, len(rows), READ_ROWS):
            if len(scores) >= wanted and np.partition(scores, -wanted)[-wanted] > bounds[at]:
                break
            scores = np.concatenate([scores, self.vectors[rows[at:at + READ_ROWS]].astype(np.float64) @ query])
        return self._listed(rows[:len(scores)].tolist(), [int(s) for s in scores])

    def _listed(self, rows, scores: list[int]) -> list[tuple[int, list[int]]]:
        ranked = sorted(zip(scores, rows), key=lambda x: -x[0])
        edge = ranked[min(len(ranked), self.k + self.spare) - 1][0]
        return [(s, self.ids[r]) for s, r in ranked if s >= edge]


def _answers(found: list[tuple[int, list[int]]], own: int, k: int) -> list[tuple[int, int]]:
    rows = [(-s, i) for s, ids in found for i in ids if i != own]
    return sorted(rows)[:k]


def _usable(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Rows that take part: id, integer vector (as doubles), dim, mark."""
    y = lambda x: x.cast("double") * F.lit(float(scale))
    whole = lambda x: F.rint(y(x)) - (F.rint(y(x)) > y(x)).cast("double") + F.lit(0.0)
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(y(x)) & (F.abs(y(x)) < F.lit(float("inf"))), F.lit(False)))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(v, whole).alias("vector"), F.size(v).alias("dim")
                       ).withColumn("mark", F.xxhash64("vector"))


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """The batch cut where block or kind of row changes."""
    keys = np.stack([np.asarray(b.column(c)).astype(np.int64) for c in ("dim", "block", "kind")])
    cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            dim, block, kind = keys[:, lo].tolist()
            yield (dim, block), kind, b.slice(lo, hi - lo)


def _columns(b: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.asarray(b.column("vector").flatten(), dtype=np.float64).reshape(b.num_rows, dim)
    if np.abs(vectors).max(initial=0) < 1 << 31:
        vectors = vectors.astype(np.int32)
    return np.asarray(b.column("id")), np.asarray(b.column("mark")), vectors


def top_k(base: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE, block_values: int = BLOCK_VALUES) -> DataFrame:
    """The ``neighbours`` base rows of highest integer inner product with each query, never
    its own id: query_id, rank, vec_id, score."""
    base, queries = _usable(base, id_col, vector_col, scale), _usable(queries, id_col, vector_col, scale)
    values = base.agg(F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()[0]
    blocks = max(input_partitions(base), -(-values // block_values))
    rows = base.select("dim", F.pmod(F.xxhash64("id", "mark"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "mark", "id", "vector")
    asks = queries.dropDuplicates(["id", "vector"]).select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.lit(1).alias("kind"), "mark", "id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, file = None, [], None
        for batch in batches:
            for (dim, block), kind, part in _runs(batch):
                if (dim, block) != key:
                    key, parts, file = (dim, block), [], None
                if kind == 0:
                    parts.append(_columns(part, dim))
                    continue
                if file is None and parts:
                    file, parts = ApproximationFile(*(np.concatenate(x) for x in zip(*parts)), neighbours), []
                if file is None:
                    continue
                ids, marks, vectors = _columns(part, dim)
                # queries come in the order of their marks: equal ones are searched once
                fresh = np.ones(len(ids), bool)
                fresh[1:] = (marks[1:] != marks[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
                askers = np.split(np.arange(len(ids)), np.flatnonzero(fresh)[1:])
                out: list[tuple[int, int, int, int]] = []
                for who, found in zip(askers, file.search(vectors[fresh].astype(np.float64))):
                    for a in who.tolist():
                        own = int(ids[a])
                        out += [(own, int(marks[a]), i, -s) for s, i in _answers(found, own, neighbours)]
                cols = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "asks", "vec_id", "score"])

    near = rows.unionByName(asks).repartition(blocks, "dim", "block").sortWithinPartitions("dim", "block", "kind", "mark", "id").mapInArrow(
        run, "query_id long, asks long, vec_id long, score long")
    order = Window.partitionBy("query_id", "asks").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
