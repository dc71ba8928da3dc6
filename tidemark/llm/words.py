"""Words of many texts at once, as 64-bit hashes, on the bytes of a text column."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x9E6C63D0876A9A47)  # odd, so that every place of a word counts

# Bytes that end a word: blank and 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# Bytes of ASCII letters and digits and of all other scripts.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
_A_TO_Z = np.arange(256, dtype=np.uint8)
_A_TO_Z[65:91] += 32

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 256)
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _PRIME)]))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _A_TO_Z[data]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A-Z lowered, and the upper-case letters of the Latin-1 block."""
    low = _A_TO_Z[data]
    second = np.zeros(len(low), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[second] += 32
    return low


def hashed_words(low: np.ndarray, ends: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each text).

    ``low`` are the texts' bytes back to back, ``ends`` their offsets; a word is
    a longest run of bytes that ``part`` marks, within one text.
    """
    inside = part[low]
    # A place starts a word if no word byte of its own text stands before it.
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = ends[1:-1]
    cut = cut[cut < len(low)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    places = np.flatnonzero(inside)
    begins = np.searchsorted(places, starts)
    sizes = np.diff(np.append(begins, len(places)))
    within = np.arange(len(places)) - np.repeat(begins, sizes)
    terms = (low[places].astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[within]
    return mix(np.add.reduceat(terms, begins)), np.searchsorted(starts, ends)


def shingles(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``size`` words, the text it is from).

    A text with fewer words, but any, gives all its words as one run.
    """
    counts = np.diff(starts)
    texts = len(counts)
    owner = np.repeat(np.arange(texts), counts)
    n = len(words)
    if n >= size:
        whole = np.zeros(n - size + 1, np.uint64)
        for i in range(size):
            whole *= _PRIME
            whole += words[i : i + n - size + 1]
        kept = owner[: n - size + 1] == owner[size - 1 :]
        hashes, owners = mix(whole[kept]), owner[: n - size + 1][kept]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            more = counts[short] > i
            own[more] = own[more] * _PRIME + words[starts[short[more]] + i]
        own = mix(own ^ counts[short].astype(np.uint64) << np.uint64(56))
        hashes, owners = np.concatenate([hashes, own]), np.concatenate([owners, short])
    return hashes, owners
