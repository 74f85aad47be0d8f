"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

Each task reads its part of the corpus block by block. The words (matches of the split
pattern) that its bounded table doesn't know yet are laid out in one array of tokens. An
inverted index maps a mergeable pair, named by its rank, to the positions where it stands;
a heap yields the ranks in order. Applying a rank touches just its positions and their two
neighbours, whose new pairs enter the index; all places of a rank are one step of array
work. A word in which places of one rank touch, or a merge creates a pair of no higher rank,
is encoded by itself instead, so each word sees exactly the order of merges that encoding
it alone would. Texts are then put together from the table.

The work is per row block: no shuffle, no state beyond the table of ``TABLE_ENTRIES``
words, and hot sources or copies only make the table's hits more frequent.

Defined cases: null text counts as empty (no ids); null ids are returned as null; repeated
rows are encoded each; very long texts are one block of their own; other columns are
ignored. Decoding concatenates the vocabulary's bytes; an id outside it raises KeyError.
"""
from __future__ import annotations

import array
import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.token_counts import groups_by_bytes
from strata.llm.vocab import PieceTable, splitter

TEXT_CHARS = 1 << 23
#: Words that share one index.
WORDS_AT_ONCE = 500_000


class MergeReplay:
    """Ranks of a vocabulary and the replay of its merges over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: One more than the largest id: the token between words, which merges with nothing.
        self.edge = max(self.bytes_of) + 1
        self.pairs = {ranks[k[:i]] * self.edge + ranks[k[i:]]: r for k, r in ranks.items()
                      for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks}
        self._keys = np.array(sorted(self.pairs), np.int64)
        self._ranks = np.array([self.pairs[k] for k in self._keys.tolist()], np.int64)
        self._of_bytes = self.pair_ranks(np.repeat(self.single, 256), np.tile(self.single, 256))

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the merges of two tokens; -1 where they don't merge."""
        if not len(self._keys):
            return np.full(len(a), -1, np.int64)
        key = np.where((a < self.edge) & (b < self.edge), a * self.edge + b, -1)
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def encode_word(self, word: bytes) -> list[int]:
        """One word's merges, lowest rank first, leftmost among equals: the slow, plain way."""
        tokens, get, edge = self.single[list(word)].tolist(), self.pairs.get, self.edge
        while len(tokens) > 1:
            best = min(((r, i) for i in range(len(tokens) - 1)
                        if (r := get(tokens[i] * edge + tokens[i + 1])) is not None), default=None)
            if best is None:
                break
            r, i = best
            tokens[i:i + 2] = [r]
        return tokens

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        raw = [w.encode() for w in words]
        out: list = [None if r is None else [r] for r in map(self.ranks.get, raw)]
        open_words = [w for w, ids in enumerate(out) if ids is None]
        if open_words:
            for w, ids in zip(open_words, self._replay([raw[w] for w in open_words])):
                out[w] = ids
        return out

    def _replay(self, words: list[bytes]) -> list[list[int]]:
        """All merges of some words in rank order, over one array of tokens."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        # an edge before each word and one after the last
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        n = int(starts[-1]) + 1
        inside = np.ones(n, bool)
        inside[starts] = False
        letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        tokens = np.full(n, self.edge, np.int64)
        tokens[inside] = self.single[letters]
        rank_at = np.full(n, -1, np.int64)
        spread = np.zeros(n, np.int64)
        spread[inside] = letters
        first = np.flatnonzero(inside[:-1] & inside[1:])
        rank_at[first] = self._of_bytes[spread[first] * 256 + spread[first + 1]]
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)

        # the inverted index: places by rank as they stand at first, and those made later
        first = first[rank_at[first] >= 0]
        first = first[np.argsort(rank_at[first], kind="stable")]
        ranks, cuts = np.unique(rank_at[first], return_index=True)
        begun = dict(zip(ranks.tolist(), np.split(first, cuts[1:])))
        made: dict[int, list[int]] = {}
        heap = ranks.tolist()
        alone = np.zeros(len(words) + 1, bool)
        while heap:
            r = heapq.heappop(heap)
            parts = [x for x in (begun.pop(r, None), made.pop(r, None)) if x is not None]
            if not parts:
                continue
            p = np.asarray(parts[0], np.int64) if len(parts) == 1 else np.concatenate(parts)
            # a place is stale when a neighbouring merge has taken either token
            p = p[rank_at[p] == r]
            if len(p) > 1:
                p = np.unique(p)
                near = (right[p[:-1]] == p[1:]) | (right[right[p[:-1]]] == p[1:])
                if near.any():
                    # places that touch: their word is encoded by itself, where order tells
                    self._set_apart(p[1:][near], starts, alone, rank_at)
                    p = p[rank_at[p] == r]
            if not len(p):
                continue
            q = right[p]
            after, before = right[q], left[p]
            tokens[p], tokens[q], rank_at[q] = r, -1, -1
            right[p], left[after] = after, p
            both = np.concatenate([before, p])
            new = self.pair_ranks(tokens[both], tokens[np.concatenate([p, after])])
            rank_at[both] = new
            ahead = new >= 0
            both, new = both[ahead], new[ahead]
            if len(new) and new.min() <= r:
                # a merge made a pair that is due before the others of this rank
                self._set_apart(both[new <= r], starts, alone, rank_at)
                ahead = rank_at[both] == new
                both, new = both[ahead], new[ahead]
            for place, rank in zip(both.tolist(), new.tolist()):
                held = made.get(rank)
                if held is not None:
                    held.append(place)
                else:
                    made[rank] = [place]
                    if rank not in begun:
                        heapq.heappush(heap, rank)
        kept = tokens >= 0
        kept[starts] = False
        ids = tokens[kept].tolist()
        ends = np.cumsum(kept)[starts].tolist()
        out = [ids[lo:hi] for lo, hi in zip(ends, ends[1:])]
        for w in np.flatnonzero(alone).tolist():
            out[w] = self.encode_word(words[w])
        return out

    @staticmethod
    def _set_apart(places: np.ndarray, starts: np.ndarray, alone: np.ndarray, rank_at: np.ndarray) -> None:
        """Marks the words of these places; none of their places is valid afterwards."""
        for w in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
            alone[w] = True
            rank_at[starts[w]:starts[w + 1]] = -1


class ByteBpe:
    """Encoder and decoder of a rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.replay = MergeReplay(ranks)
        self.find = splitter(pattern)
        self.table = PieceTable(self.replay.encode_words, batch=WORDS_AT_ONCE)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.table.ids([self.find(t) for t in texts])

    def decode(self, ids: array.array) -> bytes:
        return b"".join(map(self.replay.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _ids(raw: bytes) -> array.array:
    a = array.array("I")
    a.frombytes(raw)
    return a


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids: little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups_by_bytes(texts, TEXT_CHARS):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(bpe.encode(texts[lo:hi]), pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` plus decoded: the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for b in batches:
            decoded = [bpe.decode(_ids(raw)) for raw in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(decoded, pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids, in one Python worker a task: doc_id, n_tokens, ids_sha256
    (of the decimal ids joined by commas) and decoded (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        text_of = [str(i) for i in range(max(bpe.replay.bytes_of) + 1)]
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups_by_bytes(texts, TEXT_CHARS):
                rows = [_ids(raw) for raw in bpe.encode(texts[lo:hi])]
                sums = [hashlib.sha256(",".join(map(text_of.__getitem__, ids)).encode()).hexdigest() for ids in rows]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array([len(ids) for ids in rows], pa.int64()), pa.array(sums, pa.string()),
                     pa.array([bpe.decode(ids) for ids in rows], pa.binary())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")
