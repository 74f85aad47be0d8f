"""Ranked lexical search: exact top-k documents of each item by a dual-tree search.

Scores are integers: a document's score for an item is the sum over the item's distinct
terms of ``weight(term) * gain(tf, length)``. Items come in blocks of about
``BLOCK_CHARS`` characters, the only thing that is broadcast; for each block:

1. Every whole text is cut into terms once. Kept of a document are its length and its
   counts of the block's terms; what is stored in the shared folder follows the input.
2. Number of documents, total length and document frequencies are summed over all of
   them (partial sums first; the result is bounded by the block's terms).
3. Items become a tree, by their weightiest terms: nodes hold the largest weight of each
   term. A task takes its documents in tiles of ``TILE_DOCS``, sorted by their weightiest
   terms, and builds a tree over each tile, whose nodes hold the largest gain of each term.
   A pair of nodes is bounded by the sum of products of these maxima. It is dropped, with
   all its items and documents, if that is under the weakest k-th score of the node's items;
   else both sides are opened, and documents of the leaves are scored exactly.
4. The k-th scores start from those of a first search over one document in ``SEED_SHARE``.
   The k-th best of any part of the documents is at most the true one, so this loses nothing;
   the search itself runs over every document.

Documents are never shuffled: tasks send at most k rows an item, which a window merges.
Memory of a task: a tile and the block's items.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII;
only A-Z are lower-cased. Defined cases: null and empty texts have no terms; documents
without a term count nowhere; items without one get no rows; equal scores go by doc_id,
null first; repeated documents are ranked each; repeated items (id and terms) are one, and
an id with several texts is answered, ranks from 1, for each; empty tables give no rows;
extra columns are ignored. The least long stands for null among the ids.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

TOP = 50
BLOCK_CHARS = 1 << 20
TILE_DOCS = 1024
#: Documents in a leaf and nodes in the node above it; items likewise.
DOC_FANOUT, ITEM_FANOUT = 16, 8
SEED_SHARE = 16
_NULL_ID = -(1 << 63)

_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, with repeats."""
    return text.encode().translate(_LETTERS).split() if text else []


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def gains(tf: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term's occurrences add to a score, before its weight."""
    m = 50 + (50 * lengths * documents) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class ItemTree:
    """Items (arrays of term numbers) in the order of their weightiest terms, in nodes of
    ``ITEM_FANOUT`` and in nodes of as many nodes."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray):
        self.items, self.weights = items, weights
        heavy = [tuple(t[np.argsort(-weights[t], kind="stable")[:2]].tolist()) for t in items]
        order = sorted((i for i, t in enumerate(items) if len(t)), key=lambda i: heavy[i])
        leaves = [order[a:a + ITEM_FANOUT] for a in range(0, len(order), ITEM_FANOUT)]
        self.roots = [(self._terms(sum(part, [])), sum(part, []), [(self._terms(leaf), leaf) for leaf in part])
                      for part in (leaves[a:a + ITEM_FANOUT] for a in range(0, len(leaves), ITEM_FANOUT))]
        # sums of products stay below this; doubles hold them exactly, or integers do
        peak = max((int(weights[t].sum()) for t, _, _ in self.roots), default=0) * 1_000_000
        self.kind = np.float64 if peak < 1 << 53 else np.int64

    def _terms(self, items: list[int]) -> np.ndarray:
        # a weight is the term's own, so the largest over a node's items is that weight
        return np.unique(np.concatenate([self.items[i] for i in items]))


class Best:
    """The k best (score, id) of each item, and the score below which nothing is wanted."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * items

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, d = np.concatenate([self.rows[item][0], scores]), np.concatenate([self.rows[item][1], ids])
        order = np.lexsort((d, -s))[:self.k]
        self.rows[item] = s[order], d[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], s[order[-1]])


def search_tile(tree: ItemTree, best: Best, ids: np.ndarray, starts: np.ndarray, numbers: np.ndarray, gain: np.ndarray) -> Counter:
    """Dual-tree search of one tile; document ``i`` has the terms ``starts[i]:starts[i + 1]``.
    Returns how many pairs of nodes were bounded and left, and documents scored."""
    told: Counter = Counter()
    n = len(ids)
    doc = np.repeat(np.arange(n), np.diff(starts))
    # documents in the order of their two weightiest terms
    worth = tree.weights[numbers] * gain
    rank = np.lexsort((-worth, doc))
    first = np.minimum(starts[:-1], max(len(numbers) - 1, 0))
    second = np.minimum(first + 1, np.maximum(starts[1:] - 1, first))
    order = np.lexsort((numbers[rank[second]], numbers[rank[first]]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    own, at = np.unique(numbers, return_inverse=True)
    leaves = -(-n // DOC_FANOUT)
    nodes = -(-leaves // DOC_FANOUT)
    docs = np.zeros((len(own), nodes * DOC_FANOUT * DOC_FANOUT), tree.kind)
    docs[at, place[doc]] = gain
    leaf = docs.reshape(len(own), -1, DOC_FANOUT).max(axis=2)
    node = leaf.reshape(len(own), -1, DOC_FANOUT).max(axis=2)
    ids = ids[order]
    local = np.full(len(tree.weights), -1)
    local[own] = np.arange(len(own))
    weights = tree.weights.astype(tree.kind)

    def bounds(terms_: np.ndarray, level: np.ndarray, which: np.ndarray) -> np.ndarray:
        rows = local[terms_]
        there = rows >= 0
        told["bounded"] += len(which)
        return weights[terms_[there]] @ level[np.ix_(rows[there], which)]

    def opened(terms_: np.ndarray, items: list[int], level: np.ndarray, which: np.ndarray) -> np.ndarray:
        most = bounds(terms_, level, which)
        out = which[(most > 0) & (most >= best.least[items].min())]
        told["left"] += len(out)
        return out

    below = np.arange(DOC_FANOUT)
    for root_terms, root_items, parts in tree.roots:
        left = opened(root_terms, root_items, node, np.arange(node.shape[1]))
        if not len(left):
            continue
        children = (left[:, None] * DOC_FANOUT + below).ravel()
        for part_terms, items in parts:
            pairs = opened(part_terms, items, leaf, children)
            for i in items if len(pairs) else ():
                mine = opened(tree.items[i], [i], leaf, pairs)
                if not len(mine):
                    continue
                which = (mine[:, None] * DOC_FANOUT + below).ravel()
                which = which[which < n]
                scores = bounds(tree.items[i], docs, which).astype(np.int64)
                told["scored"] += len(which)
                good = (scores > 0) & (scores >= best.least[i])
                if good.any():
                    best.add(i, scores[good], ids[which[good]])
    return told


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct items as (item_id, terms)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [sorted(set(terms(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([[x.decode() for x in o] for o in own], pa.list_(pa.string()))], ["item_id", "terms"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item_id long, terms array<string>").where(F.size("terms") > 0).distinct()


def _counted(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """Documents with a term: doc_id, n, numbers and tf of the block's terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for b in batches:
            lengths, keys, counts, sizes = [], [], [], []
            for t in b.column("text"):
                found = terms(t.as_py())
                tf = Counter(map(number, found))
                tf.pop(None, None)
                lengths.append(len(found))
                keys.extend(tf)
                counts.extend(tf.values())
                sizes.append(len(tf))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rows = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(keys, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], ["doc_id", "n", "numbers", "tf"])
            yield rows.filter(pa.array(np.array(lengths, np.int64) > 0))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, numbers array<int>, tf array<long>")


def _found(rows: DataFrame, shared, documents: int, total: int, k: int) -> DataFrame:
    """The best k of each task for each item: (item, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, least = shared.value
        tree = ItemTree(items, weights)
        best = Best(len(items), k, least)
        for b in batches:
            for lo in range(0, b.num_rows, TILE_DOCS):
                part = b.slice(lo, TILE_DOCS)
                sizes = np.asarray(part.column("numbers").value_lengths()).astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                numbers, tf = (np.asarray(part.column(c).flatten()).astype(np.int64) for c in ("numbers", "tf"))
                gain = gains(tf, np.repeat(np.asarray(part.column("n")), sizes), documents, total)
                search_tile(tree, best, np.asarray(part.column("doc_id").fill_null(_NULL_ID)), starts, numbers, gain)
        which = np.repeat(np.arange(len(items)), [len(s) for s, _ in best.rows])
        scores, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*best.rows)) if items else (which, which)
        yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array(ids, mask=ids == _NULL_ID), pa.array(scores)], ["item", "doc_id", "score"])

    return rows.where(F.size("numbers") > 0).mapInArrow(run, "item int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for r in rows for t in r["terms"]}))}
    shared = spark.sparkContext.broadcast({t.encode(): i for t, i in vocabulary.items()})
    counted = stored(_counted(docs, shared, id_col, text_col), "lexical-counts")
    documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.full(len(vocabulary), weight(documents, 0), np.int64)
    for number, df in counted.select(F.explode("numbers").alias("number")).groupBy("number").count().collect():
        weights[number] = weight(documents, df)
    # a term of weight 0 adds nothing to any score
    items = [np.array([n for n in (vocabulary[t] for t in r["terms"]) if weights[n] > 0], np.int64) for r in rows]
    least = np.zeros(len(items), np.int64)
    part = counted.where(F.pmod(F.xxhash64("doc_id", "n", "numbers"), F.lit(SEED_SHARE)) == 0)
    first = _ranked(_found(part, spark.sparkContext.broadcast((items, weights, least)), documents, total, k), k)
    for item, score in first.where(F.col("rank") == k).select("item", "score").collect():
        least[item] = score
    found = _ranked(_found(counted, spark.sparkContext.broadcast((items, weights, least)), documents, total, k), k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Each item's ``k`` documents of highest score above 0: item_id, rank, doc_id, score."""
    cut = stored(_item_terms(items, item_id_col, item_text_col).withColumn(
        "chars", F.length(F.concat_ws(" ", "terms")).cast("long")), "lexical-items")
    chars = cut.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    out = None
    for block in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        if rows or (out is None and block == blocks - 1):
            found = _search_block(docs, rows, k, id_col, text_col)
            out = found if out is None else out.unionByName(found)
    return out
