"""Words of many texts at once: where they are and a 64-bit hash of each, without a Python object per word.

A word is a longest run of the bytes of an alphabet. The hash of a word is a polynomial of its bytes modulo
2^64, mixed; differences of running sums give the hashes of all words of a block in a few array operations. Modulo a
power of two some long words over few letters have one polynomial whatever its base, so words of more than ``SHORT`` bytes get
a keyed BLAKE2b digest of 64 bits instead.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np

BLOCK = 1 << 18
#: Bytes of the longest word that is told apart by a polynomial: up to there no two words must share more than 14 bits.
SHORT = 16
#: Everything but the ASCII white space characters.
NOT_SPACE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
#: ASCII digits and lower-case letters, and every byte of characters beyond ASCII.
LETTERS_DIGITS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
SAME = np.arange(256, dtype=np.uint8)
#: A-Z as a-z.
LOWER = np.where((SAME >= 0x41) & (SAME <= 0x5A), SAME + 32, SAME).astype(np.uint8)


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    #: Words of each text.
    counts: np.ndarray


class Hasher:
    """Hashes words over an alphabet, after folding bytes; equal seeds give equal hashes everywhere."""

    def __init__(self, alphabet: np.ndarray = NOT_SPACE, fold: np.ndarray = SAME, seed: int = 1) -> None:
        random = np.random.Generator(np.random.PCG64(seed))
        values = random.integers(0, 2 ** 64, 257, dtype=np.uint64) | np.uint64(1)
        base = int(values[256]) // 8 * 8 + 5
        self.is_word, self.code = alphabet[fold], values[:256][fold]
        self._given, self._fold, self._key = (alphabet, fold, seed), fold, seed.to_bytes(8, "little")
        self._base, self._inverse = base, pow(base, -1, 2 ** 64)
        self._grow(BLOCK)

    def __reduce__(self):
        return Hasher, self._given

    def _grow(self, size: int) -> None:
        self._powers, self._back = (np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])
                                    for x in (self._base, self._inverse))
        np.multiply.accumulate(self._powers, out=self._powers)
        np.multiply.accumulate(self._back, out=self._back)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """The words of the texts that lie in ``data`` between the offsets."""
        offsets = offsets - offsets[0]
        inside = self.is_word[data]
        change = np.zeros(len(data) + 1, bool)
        change[:-1] = inside
        change[1:] ^= inside
        begins = change[:-1] & inside
        last = change[1:] & inside
        filled = offsets[:-1][np.diff(offsets) > 0]
        begins[filled] |= inside[filled]
        last[filled[1:] - 1] |= inside[filled[1:] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
        counts = np.diff(np.searchsorted(starts, offsets))
        return Words(starts, ends, self.hashes(data, starts, ends), counts)

    def prefixes(self, data: np.ndarray, words: Words, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word; of the whole word where it is shorter."""
        return self.hashes(data, words.starts, np.minimum(words.ends, words.starts + size))

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, side="right")))
            begin, size = starts[at], int(ends[upto - 1] - starts[at])
            if size >= len(self._powers):
                self._grow(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.code[data[begin: begin + size]] * self._powers[:size], out=sums[1:])
            first = starts[at:upto] - begin
            out[at:upto] = (sums[ends[at:upto] - begin] - sums[first]) * self._back[first]
            at = upto
        out = mixed(out)
        for n in np.flatnonzero(ends - starts > SHORT):
            word = self._fold[data[starts[n]: ends[n]]].tobytes()
            out[n] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self._key).digest(), "little")
        return out


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value (the finalizer of MurmurHash3)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words; windows may reach over the end of a text."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    base, out = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(hashes) - size + 1, np.uint64)
    for at in range(size):
        out = out * base + hashes[at: len(hashes) - size + 1 + at]
    return mixed(out)


def of_text(counts: np.ndarray) -> np.ndarray:
    """The number of its text for each word."""
    return np.repeat(np.arange(len(counts)), counts)


def inside_text(counts: np.ndarray, size: int) -> np.ndarray:
    """Where windows of ``size`` words begin that stay inside one text."""
    total = int(counts.sum())
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return np.flatnonzero(left >= size)
