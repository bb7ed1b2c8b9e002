"""Words of a text and 64-bit hashes of words and shingles, for task functions.

Both kinds of words work on UTF-8 bytes with A-Z lower-cased. Separators are
ASCII, so splitting bytes gives the same words as splitting characters.
"""

from __future__ import annotations

import hashlib

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: All ASCII but digits and letters separates.
_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
               else 32 for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Random values of the bytes, A-Z as a-z, and an odd factor with its inverse modulo 2 ** 64.
_BYTE = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)[np.frombuffer(_LOWER, np.uint8)]
_FACTOR, _INVERSE = np.uint64(0xD1342543DE82EF95), np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))
#: Bytes hashed at a time: their arrays fit into a core's cache.
_PIECE = 1 << 15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def space_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+``."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_ALNUM).split()


class WordHashes(dict):
    """Hash of each word, computed once while the word is remembered."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_FACTOR, 2 * _PIECE), _powers(_INVERSE, 2 * _PIECE)


def block_words(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r"""Hashes of the words ``[^\x20\x09-\x0D]+`` of texts that lie one after another in
    ``data``, A-Z in lower case, and the number of words of each text. A hash is the sum of
    the values of a word's bytes times the powers of a factor; no word becomes an object."""
    codes = np.frombuffer(data, np.uint8)
    ends = np.cumsum(sizes)
    inside = ~_SPACE[codes]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = sizes > 0
    opens[(ends - sizes)[filled]] = inside[(ends - sizes)[filled]]
    closes[ends[filled] - 1] = inside[ends[filled] - 1]
    first, behind = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    found = np.empty(len(first), np.uint64)
    k = 0
    while k < len(first):
        at = int(first[k])
        stop = max(int(np.searchsorted(behind, at + 2 * _PIECE, "right")), k + 1)
        n = int(behind[stop - 1]) - at
        up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_FACTOR, n), _DOWN)  # one word longer than a piece
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[codes[at:at + n]] * up[:n], out=total[1:])
        low, high = first[k:stop] - at, behind[k:stop] - at
        found[k:stop] = mix((total[high] - total[low]) * down[low] + (high - low).astype(np.uint64))
        k = stop
    return found, np.diff(np.searchsorted(first, np.r_[0, ends]))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, size):
        total = mix(total * _MULTIPLIER + hashes[i:i + n])
    return mix(total + np.uint64(size))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values; empty if there are fewer."""
    least, covered = values, 1
    while 2 * covered <= width:
        least, covered = np.minimum(least[:-covered], least[covered:]), 2 * covered
    rest = width - covered
    return np.minimum(least[:-rest], least[rest:]) if rest else least
