"""Token ids in directly addressable code files, written and read back by Spark.

Rows are range-partitioned and sorted by id, tokenized in that order, and packed into
*segments* of about ``SEGMENT_TOKENS`` ids. Segments are the records of a parquet table in
the shared folder, so Spark's commit protocol covers retried and lost tasks.

A segment splits each id into 8-bit chunks, lowest first. Level k holds the chunk k of
every id that has one, a bitmap telling which of them continue on level k + 1, and a rank
directory: the ones before each block of 512 bits. Token i is then read by one byte access
and one rank per level; no block is decoded. ``Segment.token`` does this, ``Segment.ids``
reads a whole range.

Defined cases: null text counts as empty (its end id alone); null ids come first; equal
ids are ordered by their text's hash, and exact repeats are written each; an empty table
gives an empty store; only id and text columns are read.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import input_partitions, stored
from strata.llm.token_counts import groups_by_bytes
from strata.llm.vocab import byte_level_ids

END_ID = 2
SEGMENT_TOKENS = 1 << 20
TEXT_CHARS = 1 << 22

_HEAD = struct.Struct("<4sIQI")
_LEVEL = struct.Struct("<Q")
_MAGIC = b"DAC1"
#: Bits for each entry of the rank directory.
_RANK_BLOCK = 512


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of one segment: header, document directory, levels."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // _RANK_BLOCK) * (_RANK_BLOCK // 8), np.uint8)
        padded[:len(bits)] = bits
        ones = np.unpackbits(padded.reshape(-1, _RANK_BLOCK // 8), axis=1).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32) if len(ones) else np.zeros(0, np.uint32)
        levels.append(_LEVEL.pack(len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + padded.tobytes() + directory.tobytes())
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], np.int64)
    return b"".join([_HEAD.pack(_MAGIC, len(levels), len(ids), len(doc_ids)), known.tobytes(), named.tobytes(),
                     np.array(lengths, np.uint64).tobytes(), *levels])


class Segment:
    """Random access to one packed segment."""

    def __init__(self, data: bytes):
        magic, n_levels, self.n_tokens, n_docs = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        known = take(np.uint8, n_docs)
        named = take(np.int64, n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(named, known)]
        self.starts = np.concatenate([[0], np.cumsum(take(np.uint64, n_docs))]).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take(np.uint64, 1)[0])
            blocks = -(-n // _RANK_BLOCK)
            self.levels.append((take(np.uint8, n), take(np.uint8, blocks * (_RANK_BLOCK // 8)), take(np.uint32, blocks)))

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // _RANK_BLOCK
        first = block * (_RANK_BLOCK // 8)
        bits = int.from_bytes(bitmap[first:i // 8 + 1].tobytes(), "little") & ((1 << (i - block * _RANK_BLOCK)) - 1)
        return int(directory[block]) + bits.bit_count()

    def token(self, i: int) -> int:
        """The i-th id of the segment."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bitmap[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(bitmap, directory, i)
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        out = np.zeros(self.n_tokens, np.uint32)
        where = np.arange(self.n_tokens)
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            out[where] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            where = where[np.unpackbits(bitmap, bitorder="little")[:len(chunks)].view(bool)]
        return out


def write_tokens(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the store; its segments as rows: part, segment, before (the part's ids ahead
    of the segment), n_docs, n_tokens, payload."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_ids(tokenizer, pattern)
        part, segment, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], np.uint32).tobytes()
        doc_ids, lengths, chunks, n = [], [], [], 0

        def flush():
            nonlocal segment, before, doc_ids, lengths, chunks, n
            payload = pack_segment(doc_ids, lengths, np.frombuffer(b"".join(chunks), np.uint32))
            row = [[part], [segment], [before], [len(doc_ids)], [n], [payload]]
            segment, before = segment + 1, before + n
            doc_ids, lengths, chunks, n = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _TYPES)], _NAMES)

        for b in batches:
            names, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for lo, hi in groups_by_bytes(texts, TEXT_CHARS):
                for name, ids in zip(names[lo:hi], encode(texts[lo:hi])):
                    doc_ids.append(name)
                    chunks += (ids, end)
                    lengths.append(len(ids) // 4 + 1)
                    n += lengths[-1]
                    if n >= SEGMENT_TOKENS:
                        yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(input_partitions(docs), *key).sortWithinPartitions(*key)
    return stored(ordered.mapInArrow(pack, ", ".join(f"{n} {'binary' if n == 'payload' else 'long'}" for n in _NAMES)), "token-store")


_NAMES = ["part", "segment", "before", "n_docs", "n_tokens", "payload"]
_TYPES = [pa.int64()] * 5 + [pa.binary()]


def read_tokens(store: DataFrame, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """One row per document from the store: doc_id, start (ids of all documents before
    it), n_tokens and the crc32 of its ids (or another ``digest``)."""
    crc = digest or (lambda ids: zlib.crc32(ids.tobytes()))
    sizes = {r["part"]: r["n"] for r in store.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n")).collect()}
    bases, seen = [], 0
    for p in range(max(sizes, default=-1) + 1):
        bases.append(seen)
        seen += sizes.get(p, 0)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, before, payload in zip(*(b.column(c).to_pylist() for c in ("part", "before", "payload"))):
                s = Segment(payload)
                ids, at = s.ids(), s.starts
                sums = [crc(ids[at[k]:at[k + 1]]) for k in range(len(s.doc_ids))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.doc_ids, pa.int64()), pa.array([part] * len(sums), pa.int64()), pa.array(at[:-1] + before, pa.int64()),
                    pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    rows = store.select("part", "before", "payload").mapInArrow(
        unpack, "doc_id long, part long, at long, n_tokens long, ids_crc32 long")
    base = F.get(F.array(*[F.lit(x).cast("long") for x in bases or [0]]), F.col("part").cast("int"))
    return rows.select("doc_id", (F.col("at") + base).alias("start"), "n_tokens", "ids_crc32")
