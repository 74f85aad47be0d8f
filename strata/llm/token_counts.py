"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts are cut at safe boundaries into segments whose counts add up to the text's count.
Segments already counted by the worker come from a bounded table; the others are encoded
by the library in batches of about ``batch_bytes`` bytes, so one very long text or many
short ones make batches of the same size. Only (doc_id, n_bytes, n_tokens, over_limit)
leaves a task; nothing is shuffled, so skewed sources or copies need no care.

A safe boundary of the piece model is a single space between two characters that are
neither a space nor the piece model's own space mark: no piece spans such a place (every
piece holds the mark only at its start, or is made of marks alone), and the library puts
the same mark before a segment that the space would have become.

Defined cases: null text counts as empty (0 bytes, 0 tokens); a null doc_id is returned
as null; repeated rows are counted each; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 4096
BATCH_BYTES = 1 << 20
TABLE_ENTRIES = 400_000
#: Longer segments are encoded but not remembered.
REMEMBER_CHARS = 64

_MARK = "▁"
_SAFE = re.compile(f"(?<=[^ {_MARK}]) (?=[^ {_MARK}])")


def segments(text: str) -> list[str]:
    """The text cut at every safe boundary."""
    if not text:
        return []
    if "  " not in text and _MARK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return _SAFE.split(text)


class SegmentCounter:
    """Counts of segments, remembered up to ``entries`` of them; then it starts anew."""

    def __init__(self, encode_lengths: Callable[[list[str]], list[int]], entries: int = TABLE_ENTRIES,
                 batch_bytes: int = BATCH_BYTES):
        self.encode_lengths, self.entries, self.batch_bytes = encode_lengths, entries, batch_bytes
        self.known: dict[str, int] = {}

    def _learn(self, new: Iterable[str], into: dict[str, int]) -> None:
        batch, size = [], 0
        for s in new:
            batch.append(s)
            size += len(s)
            if size >= self.batch_bytes:
                into.update(zip(batch, self.encode_lengths(batch)))
                batch, size = [], 0
        if batch:
            into.update(zip(batch, self.encode_lengths(batch)))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.entries:
            self.known.clear()
        known, rare = self.known, {}
        cut = [segments(t) for t in texts]
        new = {s for parts in cut for s in parts if s not in known}
        self._learn((s for s in new if len(s) <= REMEMBER_CHARS), known)
        self._learn((s for s in new if len(s) > REMEMBER_CHARS), rare)
        if rare:
            return [sum(known[s] if s in known else rare[s] for s in parts) for parts in cut]
        return [sum(map(known.__getitem__, parts)) for parts in cut]


@lru_cache(maxsize=2)
def _piece_counter(model: str) -> SegmentCounter:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    return SegmentCounter(lambda batch: [len(x) for x in sp.encode(batch, num_threads=1)])


def groups_by_bytes(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``most`` characters together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _piece_counter(model)
        for b in batches:
            texts = b.column("text").to_pylist()
            counts: list[int] = []
            for lo, hi in groups_by_bytes(texts, 4 * BATCH_BYTES):
                counts += counter.counts(texts[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(lengths, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > max_tokens)
