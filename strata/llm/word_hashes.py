"""XXH3 hashes (64 bits) of all words of a buffer as array work: the values that the library
gives one by one. Words of at most 16 bytes, nearly all, have closed formulas."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Words hashed at a time.
AT_ONCE = 1 << 17

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[*b" \t\n\x0b\x0c\r"]] = True
_HALF = _U(0xFFFFFFFF)
#: Fixed values of the algorithm: the parts of its secret by length, and its multipliers.
_FLIP_3, _FLIP_8 = _U(0x87275A9B), _U(0x1CAD21F72C81017C ^ 0xDB979083E96DD4DE)
_FLIP_LOW, _FLIP_HIGH = _U(0x1F67B3B7A4A44072 ^ 0x78E5C0CC4EE679CB), _U(0x2172FFCC7DD05A82 ^ 0x8E2443F7744608B8)


def _up_to_3(b: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    first, middle, last = (b[start + k].astype(_U) for k in (0, n >> 1, n - 1))
    h = (first << _U(16) | middle << _U(24) | last | n.astype(_U) << _U(8)) ^ _FLIP_3
    h = (h ^ h >> _U(33)) * _U(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> _U(29)) * _U(0x165667B19E3779F9)
    return h ^ h >> _U(32)


def _up_to_8(low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
    h = ((high >> _U(32)) + ((low & _HALF) << _U(32))) ^ _FLIP_8
    h ^= (h << _U(49) | h >> _U(15)) ^ (h << _U(24) | h >> _U(40))
    h *= _U(0x9FB21C651E98DF25)
    h = (h ^ (h >> _U(35)) + n.astype(_U)) * _U(0x9FB21C651E98DF25)
    return h ^ h >> _U(28)


def _up_to_16(low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
    x, y = low ^ _FLIP_LOW, high ^ _FLIP_HIGH
    a, b, c, d = x & _HALF, x >> _U(32), y & _HALF, y >> _U(32)
    cross = (a * c >> _U(32)) + (b * c & _HALF) + a * d
    top = b * d + (b * c >> _U(32)) + (cross >> _U(32))
    h = n.astype(_U) + x.byteswap() + y + (x * y ^ top)
    h = (h ^ h >> _U(37)) * _U(0x165667919E3779F9)
    return h ^ h >> _U(32)


def _parts(b: np.ndarray, eights: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) by length."""
    n = end - start

    def eight(at):
        return eights[at].view("<u8").ravel()

    at = np.flatnonzero(n <= 3)
    yield at, _up_to_3(b, start[at], n[at])
    at = np.flatnonzero((n > 3) & (n <= 8))
    # eight bytes before the end: the buffer begins with as many others
    yield at, _up_to_8(eight(start[at]), eight(end[at] - 8), n[at])
    at = np.flatnonzero((n > 8) & (n <= 16))
    yield at, _up_to_16(eight(start[at]), eight(end[at] - 8), n[at])
    at = np.flatnonzero(n > 16)
    yield at, np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(start[at].tolist(), end[at].tolist())), _U, len(at))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, one after another, and where each text's words begin (with
    their number as the last)."""
    raw = b" ".join([b" " * 7, *texts, b" " * 8])
    b = np.frombuffer(raw, np.uint8)
    eights = np.lib.stride_tricks.sliding_window_view(b, 8)
    edges = np.flatnonzero(np.diff(_SPACE[b])) + 1
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), _U)
    for lo in range(0, len(starts), AT_ONCE):
        part = out[lo:lo + AT_ONCE]
        for at, h in _parts(b, eights, raw, starts[lo:lo + AT_ONCE], ends[lo:lo + AT_ONCE]):
            part[at] = h
    begin = 8 + np.cumsum([0, *(len(t) + 1 for t in texts)])
    return out, np.searchsorted(starts, begin)
