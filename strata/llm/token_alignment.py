"""Cross-tokenizer alignment: which tokens of a byte-level model and of a piece model cover
the same bytes, and how often a pair of ids is linked in the corpus.

1. *Spans.* A text (behind one space) is cut where each model always cuts it: the byte-level
   model at the matches of its split pattern, the piece model before runs of spaces. Words
   are looked up in a bounded table; new ones go to the libraries in batches, whose spans
   are the coarse cuts: character offsets of ``tokenizers``, and SentencePiece's spans (its
   immutable proto is gone from this version; the offset mapping holds the same ones).
   Where a character of several bytes was split (byte-level parts, byte-fallback pieces) the
   spans of its tokens overlap or are empty, and the decoded bytes give the cuts between
   them. A word whose joined token bytes differ from its own makes the whole text one
   without tokens.
2. *Alignment.* The tokens of both sides tile the same bytes, so places where both end
   cut them into groups, and each stretch between neighbouring ends of either side is one
   link, the pair of tokens that cover it. That is done for all texts of a block at once.
3. *Counts.* A block (about ``BLOCK_BYTES`` of text) sends each distinct pair of ids once,
   with the number of its documents; sums of these are the corpus-wide counts, and a
   window over the first id marks its highest. Blocks then fetch the counts of their pairs
   by a join on the pair (both sides stored, so that a pair that every block holds can be
   split), and sum them for each of their documents. No table is broadcast.

Memory of a task: one block, its distinct pairs, the word tables.

Defined cases: null and empty texts, and texts whose joined bytes under either model differ
from space + text (such as ones that hold the piece model's own space mark), have no
tokens: zeros, and '' for the digest. Null ids are kept; repeated rows count as documents
each; very long texts are blocks of their own; an empty table gives no rows; extra columns
are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import collector_paused, stored
from strata.llm.vocab import _LETTERS, splitter

BLOCK_BYTES = 1 << 19
TABLE_ENTRIES = 600_000
REMEMBER_CHARS = 64
_MARK = "▁"
#: Cut before the first of a run of spaces, but for one at the end: no piece holds the mark
#: behind another character.
_SPACED = re.compile(r" *[^ ]+(?: +\Z)?| +\Z")
#: Characters on whose class regular expression engines differ, and unassigned ones.
_ODD = re.compile(r"[^\n\r\t -~\xA0-ɏͰ-ԯぁ-ゖァ-ヺ一-龥가-힣]")


def spaced_words(text: str) -> list[str]:
    """The cuts of ``_SPACED`` in space + text."""
    if text and "  " not in text and text[0] != " " and text[-1] != " ":
        return [" " + w for w in text.split(" ")]
    return _SPACED.findall(" " + text)


def cut_words(words: list[bytes], ids: list[list[int]], ends: list[list[int]], decoded: list[bytes], lengths: np.ndarray) -> list[bytes | None]:
    """Each word's tokens as 64-bit integers, the id and above it the token's bytes; None if
    the joined bytes of the tokens aren't the word's.

    ``ends`` are the tokens' span ends in the word's bytes. They are the cuts where the
    library's spans tile the word; inside characters of several bytes, whose tokens have
    overlapping or empty spans, the running sum of decoded bytes is."""
    count = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(count.sum()))
    coarse = np.fromiter(chain.from_iterable(ends), np.int64, len(flat))
    stop = np.cumsum(count)
    start = stop - count
    run = np.concatenate([[0], np.cumsum(lengths[flat])])
    fine = run[1:] - np.repeat(run[start], count)
    cut = np.where(coarse == fine, coarse, fine)
    size = np.diff(cut, prepend=0)
    first = start[count > 0]
    size[first] = cut[first]
    packed = (flat | size << 32).astype(np.uint64).tobytes()
    out: list[bytes | None] = [packed[8 * lo:8 * hi] for lo, hi in zip(start.tolist(), stop.tolist())]
    joined = b"".join(map(decoded.__getitem__, flat.tolist()))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    whole = run[stop] - run[start] == sizes
    if not whole.all() or joined != b"".join(words):
        for k, w in enumerate(words):
            if joined[run[start[k]]:run[stop[k]]] != w:
                out[k] = None
    return out


class WordTokens:
    """Word -> its tokens by ``cut_words``, in two generations: when the younger is full it
    becomes the older, and what is used again moves over."""

    def __init__(self, tokenize: Callable[[list[str]], list[bytes | None]], entries: int = TABLE_ENTRIES):
        self.tokenize, self.entries, self.known, self.older = tokenize, entries // 2, {}, {}

    def of(self, cut: list[list[str]]) -> list[bytes | None]:
        """For each list of words all its tokens, or None."""
        if len(self.known) > self.entries:
            self.known, self.older = {}, self.known
        known, older, rare = self.known, self.older, {}
        new = []
        for w in set(chain.from_iterable(cut)).difference(known):
            if w in older:
                known[w] = older[w]
            else:
                new.append(w)
        for lo in range(0, len(new), 5000):
            batch = new[lo:lo + 5000]
            for w, tokens in zip(batch, self.tokenize(batch)):
                (known if len(w) <= REMEMBER_CHARS else rare)[w] = tokens
        get = (lambda w: rare[w] if w in rare else known[w]) if rare else known.__getitem__
        out: list[bytes | None] = []
        for words in cut:
            try:
                out.append(b"".join(map(get, words)))
            except TypeError:  # a word without tokens is None, which doesn't join
                out.append(None)
        return out


class ByteLevelSide:
    """Tokens of space + text under a byte-level file of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        back = {ord(c): b for b, c in _LETTERS.items()}
        vocabulary = tok.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            # an added token's string is plain text
            self.bytes[i] = bytes(back[ord(c)] for c in token) if all(ord(c) in back for c in token) else token.encode()
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.find = splitter(pattern)
        self.words = WordTokens(self._tokenize)

    def _tokenize(self, words: list[str]) -> list[bytes | None]:
        # the model takes the byte-level alphabet, in which a character is one byte
        raw = [w.encode() for w in words]
        found = list(map(self.tok.model.tokenize, [r.decode("latin-1").translate(_LETTERS) for r in raw]))
        return cut_words(raw, [[t.id for t in x] for x in found], [[t.offsets[1] for t in x] for x in found], self.bytes, self.lengths)

    def _whole(self, texts: list[str]) -> list[bytes | None]:
        raw, ids, ends = [t.encode() for t in texts], [], []
        for t in texts:
            e = self.tok.encode(t, add_special_tokens=False)
            at = [0, *accumulate(len(c.encode()) for c in t)]
            ids.append(e.ids)
            ends.append([at[end] for _, end in e.offsets])
        return cut_words(raw, ids, ends, self.bytes, self.lengths)

    def tokens(self, texts: list[str]) -> list[bytes | None]:
        spaced = [" " + t for t in texts]
        odd = [_ODD.search(t) is not None for t in spaced]
        out = self.words.of([[] if o else self.find(t) for o, t in zip(odd, spaced)])
        for k in np.flatnonzero(odd).tolist():
            out[k] = self._whole([spaced[k]])[0]
        return out


class PieceSide:
    """Tokens of a text under a SentencePiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(_MARK, " ").encode()
                      for i in range(sp.get_piece_size())]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.words = WordTokens(self._tokenize)

    def _tokenize(self, words: list[str]) -> list[bytes | None]:
        # spans count the bytes of the text without the space in front
        found = self.sp.encode([w[1:] for w in words], return_type="offset_mapping", return_bytes=True, num_threads=1)
        return cut_words([w.encode() for w in words], [x["ids"] for x in found], [[end + 1 for _, end in x["offsets"]] for x in found],
                         self.bytes, self.lengths)

    def tokens(self, texts: list[str]) -> list[bytes | None]:
        return self.words.of(list(map(spaced_words, texts)))


@lru_cache(maxsize=2)
def sides(byte_level: str, pattern: str, pieces: str) -> tuple[ByteLevelSide, PieceSide]:
    return ByteLevelSide(byte_level, pattern), PieceSide(pieces)


@lru_cache(maxsize=2)
def _names(sizes: tuple[int, int]) -> np.ndarray:
    """How the ids of both sides are written, with what follows inside a group and at its end."""
    return np.array([f"{i}{end}" for n, ends in zip(sizes, (",|", ",;")) for i in range(n) for end in ends], object)


class Aligned:
    """Alignment of a block of texts that have tokens on both sides."""

    def __init__(self, tokens: list[tuple[bytes, bytes]], sizes: tuple[int, int]):
        self.n_a, self.n_b = (np.array([len(t[side]) // 8 for t in tokens], np.int64) for side in (0, 1))
        a, b = (np.frombuffer(b"".join([t[side] for t in tokens]), np.int64) for side in (0, 1))
        ends_a, ends_b = np.cumsum(a >> 32), np.cumsum(b >> 32)
        a, b = a & 0xFFFFFFFF, b & 0xFFFFFFFF
        # the texts follow one another, so their own ends are common ones
        stretch = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = stretch[1:] == stretch[:-1]
        both, stretch = stretch[1:][again], stretch[np.append(~again, True)]
        texts = ends_a[np.cumsum(self.n_a) - 1]
        self.n_groups = np.diff(np.searchsorted(both, texts, "right"), prepend=0)
        self.link_text = np.searchsorted(texts, stretch)
        self.n_links = np.bincount(self.link_text, minlength=len(tokens))
        self.pair = a[np.searchsorted(ends_a, stretch)] << 32 | b[np.searchsorted(ends_b, stretch)]
        self.sha = self._digests(a, b, ends_a, ends_b, both, sizes)

    def _digests(self, a, b, ends_a, ends_b, both, sizes: tuple[int, int]) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        # a group's first-side tokens stand before its second-side ones
        in_a, in_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = 2 * a + (both[group_a] == ends_a)
        codes[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * (b + sizes[0]) + (both[group_b] == ends_b)
        written = _names(sizes)[codes].tolist()
        cuts = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [hashlib.sha256("".join(written[lo:hi])[:-1].encode()).hexdigest() for lo, hi in zip(cuts, cuts[1:])]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t) + 64
            if size >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "place array<int>, times array<int>, pairs array<long>, docs array<int>")


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, int), *parts]), kind))


@collector_paused()
def _aligned_rows(block: int, ids: list, texts: list[str], left: ByteLevelSide, right: PieceSide) -> pa.RecordBatch:
    """A row for each text, with its links as places in the block's sorted pairs, and a
    last row with these pairs and the number of documents that hold each."""
    both = list(zip(left.tokens(texts), right.tokens(texts)))
    good = [k for k, (x, y) in enumerate(both) if texts[k] and x is not None and y is not None]
    n = len(ids)
    counts = np.zeros((4, n), np.int64)
    sha, place, times = [""] * n, [np.zeros(0, int)] * n, [np.zeros(0, int)] * n
    pairs = docs = np.zeros(0, np.int64)
    if good:
        al = Aligned([both[k] for k in good], (len(left.bytes), len(right.bytes)))
        counts[:, good] = al.n_a, al.n_b, al.n_groups, al.n_links
        pairs, which = np.unique(al.pair, return_inverse=True)
        held, repeats = np.unique(al.link_text * len(pairs) + which, return_counts=True)
        text, which = held // len(pairs), held % len(pairs)
        docs = np.bincount(which, minlength=len(pairs))
        cuts = np.searchsorted(text, np.arange(1, len(good)))
        for k, s, p, t in zip(good, al.sha, np.split(which, cuts), np.split(repeats, cuts)):
            sha[k], place[k], times[k] = s, p, t
    none = np.zeros(0, int)
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * (n + 1), pa.int64()), pa.array([*ids, None], pa.int64()), *[pa.array([*c.tolist(), None], pa.int64()) for c in counts],
         pa.array([*sha, None], pa.string()), _lists([*place, none], pa.int32()), _lists([*times, none], pa.int32()),
         _lists([none] * n + [pairs], pa.int64()), _lists([none] * n + [docs], pa.int32())],
        [c.split()[0] for c in _ROWS.split(", ")])


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the counts of their links."""
    order = np.argsort(np.asarray(counts.column("place")))
    count = np.asarray(counts.column("held"))[order]
    best = np.asarray(counts.column("best"))[order].astype(np.int64)
    place, times = (docs.column(c).combine_chunks() for c in ("place", "times"))
    owner = np.repeat(np.arange(docs.num_rows), np.asarray(place.value_lengths()).astype(int))
    place, times = (np.asarray(x.flatten()).astype(np.int64) for x in (place, times))
    sums = []
    for value in (best, count):
        out = np.zeros(docs.num_rows, np.int64)
        if len(place):
            np.add.at(out, owner, value[place] * times)
        sums.append(pa.array(out))
    keep = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return keep.append_column("n_best", sums[0]).append_column("count_sum", sums[1]).append_column("groups_sha256", docs.column("groups_sha256"))


def align(docs: DataFrame, byte_level: str, pattern: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = sides(byte_level, pattern, pieces)
        first = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(_blocks(batches)):
            yield _aligned_rows(first + k, ids, texts, left, right)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(run, _ROWS), "alignment")
    # the last row of a block has no counts of its own
    told, own = rows.where(F.col("n_a").isNull()), rows.where(F.col("n_a").isNotNull())
    held = told.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("held"))
    a = F.shiftright("pair", 32)
    counts = stored(held.withColumn("best", F.col("held") == F.max("held").over(Window.partitionBy(a))), "alignment-counts")
    asked = told.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("asker", "place", "held", "best")
    # blocks whose texts have no tokens ask nothing, and still return their documents
    return own.drop("pairs", "docs").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
