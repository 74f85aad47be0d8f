"""Public tokenizers inside tasks: whole texts to ids, one remembered word at a time.

Both helpers cut a text where the tokenizer's own pre-tokenizer always cuts it, look the
pieces up in a bounded table, and send only unknown pieces to the library. Tokenizer files
are named by path and read on each worker."""
from __future__ import annotations

import array
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

from strata.llm.common import collector_paused

TABLE_ENTRIES = 800_000
REMEMBER_CHARS = 64


class PieceTable:
    """Piece -> its ids as little-endian unsigned 32-bit bytes, in two generations: when the
    younger is full it becomes the older, and what is used again moves over."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: int = TABLE_ENTRIES, batch: int = 10_000):
        self.encode, self.entries, self.batch, self.known, self.older = encode, entries // 2, batch, {}, {}

    def ids(self, cut: list[list[str]]) -> list[bytes]:
        """For each list of pieces, the bytes of all their ids."""
        if len(self.known) > self.entries:
            self.known, self.older = {}, self.known
        known, older, rare = self.known, self.older, {}
        new = []
        for p in set(chain.from_iterable(cut)).difference(known):
            v = older.get(p)
            if v is None:
                new.append(p)
            else:
                known[p] = v
        for lo in range(0, len(new), self.batch):
            batch = new[lo:lo + self.batch]
            for p, ids in zip(batch, self.encode(batch)):
                (known if len(p) <= REMEMBER_CHARS else rare)[p] = array.array("I", ids).tobytes()
        get = known.__getitem__ if not rare else lambda p: known[p] if p in known else rare[p]
        return [b"".join(map(get, parts)) for parts in cut]


class WordTable(dict):
    """Word -> bytes of its ids, learnt when it is first looked up; in two generations like
    ``PieceTable``."""

    def __init__(self, learn: Callable[[str], bytes], entries: int = TABLE_ENTRIES):
        super().__init__()
        self.learn, self.entries, self.older = learn, entries // 2, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= REMEMBER_CHARS:
            self[word] = ids
        return ids

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))

    def turn(self) -> None:
        """Between batches: a full table becomes the older one."""
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()


#: Fixed value: the split pattern that byte-level files are published with.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of printable ASCII, common white space and Latin letters, where the
#: standard engine's classes say all there is to say.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\n\r\t {_LATIN}0-9]+|[\n\r\t ]+(?![^\n\r\t ])|[\n\r\t ]+").findall
_NOT_PLAIN = re.compile("[^\n\r\t -~À-ÖØ-öø-ɏ]").search


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a split pattern in a text."""
    import regex

    find = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL:
        return find
    return lambda text: find(text) if _NOT_PLAIN(text) else _PLAIN(text)


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _model_ids(tok) -> Callable[[str], list[int]]:
    """Ids of one pre-tokenized piece by the library's model alone."""
    tokenize = tok.model.tokenize

    def ids(piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_LETTERS)
        elif piece[:1] == " " and piece[1:].isalpha():
            # the most frequent case
            piece = _LETTERS[32] + piece[1:]
        elif not piece.isalpha():
            piece = piece.encode().decode("latin-1").translate(_LETTERS)
        return [t.id for t in tokenize(piece)]

    return ids


class ByteLevelIds:
    """A byte-level BPE file of the tokenizers library: each match of its split pattern is
    encoded by the library's model. A text that holds an added token's string goes to the
    library whole."""

    def __init__(self, path: str, pattern: str):
        tok = _library(path)
        self.added = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.find = splitter(pattern)
        self.whole = lambda t: array.array("I", tok.encode(t, add_special_tokens=False).ids).tobytes()
        ids = _model_ids(tok)
        self.table = WordTable(lambda p: array.array("I", ids(p)).tobytes())

    @collector_paused()
    def __call__(self, texts: list[str]) -> list[bytes]:
        self.table.turn()
        odd = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        out = [b"" if i in odd else self.table.ids(self.find(t)) for i, t in enumerate(texts)]
        for i in odd:
            out[i] = self.whole(texts[i])
        return out


class SpacedWordIds:
    """A BPE file whose normalizer composes, folds white space and lower-cases, and whose
    pre-tokenizer takes contractions, runs of letters, single digits and runs of marks.

    For texts of plain characters (printable ASCII and Latin letters, which are composed
    already and lower-case one by one) that cut is made here, on the lower-cased words, which
    are remembered whole; the library's model encodes each piece of a new word. In other
    texts, what a space or line feed separates goes through the whole library."""

    odd_letter = re.compile("[^\n\r\t -~À-ÖØ-öø-ÿ]").search
    piece = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+").findall

    def __init__(self, path: str):
        tok = _library(path)
        ids = _model_ids(tok)
        self.pieces = WordTable(lambda p: array.array("I", ids(p)).tobytes(), TABLE_ENTRIES // 4)
        # words with their marks: there are more of them
        self.plain = WordTable(self._learn, 2 * TABLE_ENTRIES)
        self.words = PieceTable(lambda batch: [e.ids for e in tok.encode_batch(batch, add_special_tokens=False)], TABLE_ENTRIES // 8)

    def _learn(self, word: str) -> bytes:
        if word.isalpha():
            return self.pieces.learn(word)
        if word[:-1].isalpha() and not word[-1].isdigit():
            # the most frequent case: letters and one mark
            return self.plain[word[:-1]] + self.pieces[word[-1]]
        return self.pieces.ids(self.piece(word))

    @collector_paused()
    def __call__(self, texts: list[str]) -> list[bytes]:
        self.pieces.turn()
        self.plain.turn()
        odd = [i for i, t in enumerate(texts) if self.odd_letter(t) or "<|" in t]
        apart = set(odd)
        # no piece holds white space
        out = [b"" if i in apart else self.plain.ids(t.lower().split()) for i, t in enumerate(texts)]
        for i, ids in zip(odd, self.words.ids([texts[i].replace("\n", " ").split(" ") for i in odd])):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def byte_level_ids(path: str, pattern: str) -> ByteLevelIds:
    return ByteLevelIds(path, pattern)


@lru_cache(maxsize=2)
def spaced_word_ids(path: str) -> SpacedWordIds:
    return SpacedWordIds(path)
