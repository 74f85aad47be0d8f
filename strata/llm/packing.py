"""Lexical retrieval packing: windows filled with BM25 neighbours of a seed document.

1. Every whole text is tokenized once; ids are stored in the shared folder.
2. Document frequencies of all tokens are summed over all documents: a table bounded by
   the vocabulary, which the driver turns into one array of weights.
3. Documents are range-partitioned by their two heaviest tokens (then id), so texts on one
   matter meet in a partition, and a token that a third of all texts share is still cut
   into as many partitions as its rows need.
4. A partition is read in order, one *index shard* of about ``SHARD_TOKENS`` tokens at a
   time. The shard's inverted index maps a token to the documents that hold it and their
   BM25 weights. The first unused document seeds a window; the index looks up all its distinct
   tokens and returns its unused neighbours, best first, which fill the window greedily. The last one is cut to fit, and
   its rest seeds the next window. A window that a shard can't fill is carried to the next.
5. A partition's last, unfilled window is cut into sequences of 4096/2, /4, ... tokens, as
   powers of two need no padding.

Every id lies in exactly one piece, and no window holds padding. Memory of a task: one
shard, its index, one window.

Defined cases: null text counts as empty (its end id alone); documents without tokens to
weigh seed or follow in order; null ids sort first; repeated rows are packed each; an empty
table gives no pieces; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import input_partitions, stored
from strata.llm.token_counts import groups_by_bytes
from strata.llm.vocab import spaced_word_ids

WINDOW = 4096
END_ID = 2
K1, B = 1.2, 0.75
#: Tokens of an index shard.
SHARD_TOKENS = 1 << 21
TEXT_CHARS = 1 << 22
#: Share of an index's documents from which a token's postings are a row of a matrix.
COMMON = 0.2


def _ids(raw: bytes) -> np.ndarray:
    """Ids as they are stored between the steps: a first byte for their width, then
    unsigned integers of 16 bits where all fit, else of 32."""
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=raw[0])


def _stored_ids(ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    if wide.max() <= 0xFFFF:
        return b"\x02\0" + wide.astype("<u2").tobytes()
    return b"\x04\0\0\0" + ids


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id and ids (as ``_ids`` reads them, the end id last)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = spaced_word_ids(tokenizer)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups_by_bytes(texts, TEXT_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array([_stored_ids(x + end) for x in encode(texts[lo:hi])], pa.binary())],
                    ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


class TermWeights:
    """BM25 weights from counts over all documents."""

    def __init__(self, frequencies: dict[int, int], documents: int, tokens: int):
        self.idf = np.zeros(max(frequencies, default=-1) + 1)
        for term, df in frequencies.items():
            self.idf[term] = np.log1p((documents - df + 0.5) / (df + 0.5))
        self.mean = max(1.0, tokens / max(1, documents))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct tokens of a document (without its end id) and their weights."""
        terms, counts = np.unique(ids[:-1], return_counts=True)
        scale = K1 * (1 - B + B * (len(ids) - 1) / self.mean)
        return terms, self.idf[terms] * counts * (K1 + 1) / (counts + scale)


def term_weights(tokens: DataFrame) -> TermWeights:
    """Count documents per token over the whole table; what is collected is bounded by the
    vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: np.ndarray = np.zeros(0, np.int64)
        documents = total = 0
        for b in batches:
            for raw in b.column("ids").to_pylist():
                ids = _ids(raw)[:-1]
                documents += 1
                total += len(ids)
                if len(ids):
                    top = int(ids.max()) + 1
                    if top > len(counts):
                        counts = np.concatenate([counts, np.zeros(max(top, 2 * len(counts)) - len(counts), np.int64)])
                    # sorted and compared: np.unique hashes, which takes four times as long
                    ids = np.sort(ids)
                    counts[ids[np.append(True, ids[1:] != ids[:-1])]] += 1
        held = np.flatnonzero(counts)
        # two counts of the task itself travel under negative names
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([held, [-1, -2]])),
                                          pa.array(np.concatenate([counts[held], [documents, total]]))], ["term", "df"])

    found = tokens.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    sums = {r["term"]: r["df"] for r in found.collect()}
    documents, total = sums.pop(-1, 0), sums.pop(-2, 0)
    return TermWeights(sums, documents, total)


class ShardIndex:
    """Inverted index of some documents: token -> documents and weights. The postings of a
    token that ``COMMON`` of the documents hold are one row of a matrix; the others follow
    one another, token by token. Used documents leave the index when they are the half."""

    def __init__(self, documents: list[np.ndarray], weights: TermWeights):
        held = [weights.of(d) for d in documents]
        self.queries = [t for t, _ in held]
        self.n = len(documents)
        sizes = [len(t) for t in self.queries]
        terms = np.concatenate([np.zeros(0, np.int64), *self.queries]).astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self._lay_out(terms[order], np.repeat(np.arange(self.n), sizes)[order],
                      np.concatenate([np.zeros(0), *[w for _, w in held]])[order], np.arange(self.n))

    def _lay_out(self, terms: np.ndarray, docs: np.ndarray, weights: np.ndarray, names: np.ndarray) -> None:
        """Postings sorted by term; ``docs`` count through ``names``."""
        self.flat, self.docs, self.weights, self.names = terms, docs, weights, names
        self.terms, self.first, self.count = np.unique(terms, return_index=True, return_counts=True)
        common = self.count >= max(2, COMMON * len(names))
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.common = np.zeros((int(common.sum()), len(names)), np.float32)
        row = np.repeat(self.row, self.count)
        self.common[row[row >= 0], docs[row >= 0]] = weights[row >= 0]

    def _forget(self, live: np.ndarray) -> None:
        keep, place = live[self.docs], np.cumsum(live) - 1
        self._lay_out(self.flat[keep], place[self.docs[keep]], self.weights[keep], self.names[live])

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 scores of ``names`` for the distinct tokens of a query."""
        if not len(self.terms):
            return np.zeros(len(self.names))
        at = np.minimum(np.searchsorted(self.terms, query), len(self.terms) - 1)
        at = at[self.terms[at] == query]
        row = self.row[at]
        rare = at[row < 0]
        lo, k = self.first[rare], self.count[rare]
        posting = np.repeat(lo - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        some = np.bincount(self.docs[posting], self.weights[posting], minlength=len(self.names))
        return some + self.common[row[row >= 0]].sum(axis=0)

    def neighbours(self, query: np.ndarray, unused: np.ndarray) -> Iterator[int]:
        """Unused documents: those that share a token with the query by falling BM25 score,
        then the others in order."""
        live = unused[self.names]
        if 2 * int(live.sum()) < len(live):
            self._forget(live)
            live = unused[self.names]
        scores = np.where(live, self.scores(query), 0)
        near = np.flatnonzero(scores)
        shared = np.zeros(self.n, bool)
        shared[self.names[near]] = True
        yield from self.names[near[np.lexsort((near, -scores[near]))]].tolist()
        yield from np.flatnonzero(unused & ~shared).tolist()


class WindowFiller:
    """Packs shards one after another; the open window outlives a shard."""

    def __init__(self, weights: TermWeights, window: int = WINDOW):
        self.weights, self.window = weights, window
        self.sequence, self.filled = 0, 0
        self.query: np.ndarray | None = None
        self.open: list[list] = []

    def pack(self, names: list, documents: list[np.ndarray]) -> Iterator[list]:
        """Pieces: name, start, ids, document tokens, sequence, offset."""
        index = ShardIndex(documents, self.weights)
        unused = np.ones(len(documents), bool)
        first = 0
        while first < len(documents):
            if not unused[first]:
                first += 1
                continue
            if self.query is None:
                # the first unused document seeds the window
                yield from self._place(names[first], documents[first], index.queries[first])
                unused[first] = False
                continue
            for k in index.neighbours(self.query, unused):
                unused[k] = False
                before = self.sequence
                yield from self._place(names[k], documents[k], index.queries[k])
                if self.sequence != before:
                    break

    def _place(self, name, ids: np.ndarray, query: np.ndarray) -> Iterator[list]:
        at = 0
        while at < len(ids):
            if self.filled == 0:
                self.query = query
            part = ids[at:at + self.window - self.filled]
            self.open.append([name, at, part, len(ids), self.sequence, self.filled])
            at += len(part)
            self.filled += len(part)
            if self.filled == self.window:
                yield from self.open
                self.open, self.filled, self.query = [], 0, None
                self.sequence += 1

    def close(self) -> Iterator[list]:
        """The open window as sequences of falling powers of two."""
        left, room, at = self.filled, 0, 0
        for name, start, ids, total, _, _ in self.open:
            done = 0
            while done < len(ids):
                if room == at:
                    # a new sequence: the largest power of two that the rest fills
                    room, at = 1 << (left.bit_length() - 1), 0
                part = ids[done:done + room - at]
                yield [name, start + done, part, total, self.sequence, at]
                done, at, left = done + len(part), at + len(part), left - len(part)
                if at == room:
                    self.sequence, room, at = self.sequence + 1, 0, 0
        self.open, self.filled, self.query = [], 0, None


def _batch(rows: list[list], part: int) -> pa.RecordBatch:
    name, start, ids, total, sequence, offset = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(name, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
         pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
         pa.array([(part << 32) + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
        ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset."""
    tokens = stored(tokenize(docs, tokenizer, id_col=id_col, text_col=text_col), "packing-tokens")
    weights = term_weights(tokens)

    def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.full((b.num_rows, 2), -1, np.int64)
            for i, raw in enumerate(b.column("ids").to_pylist()):
                terms, w = weights.of(_ids(raw))
                for place in range(min(2, len(terms))):
                    # of equal weights the first, which is the smaller token; none is negative
                    best = w.argmax()
                    keys[i, place] = terms[best]
                    w[best] = -1
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                                             ["doc_id", "ids", "k1", "k2"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filler = TaskContext.get().partitionId(), WindowFiller(weights, window)
        names, documents, held = [], [], 0
        for b in batches:
            for name, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                names.append(name)
                documents.append(_ids(raw))
                held += len(documents[-1])
                if held >= shard_tokens:
                    yield _batch(list(filler.pack(names, documents)), part)
                    names, documents, held = [], [], 0
        if rest := [*filler.pack(names, documents), *filler.close()]:
            yield _batch(rest, part)

    order = ["k1", "k2", "doc_id", F.xxhash64("ids")]
    # stored, as a range partitioning first samples its input, which would weigh all again
    keyed = stored(tokens.mapInArrow(heaviest, "doc_id long, ids binary, k1 long, k2 long"), "packing-keys")
    dealt = keyed.repartitionByRange(input_partitions(docs), *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(
        fill, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
