"""A wavelet matrix over token ids: bit planes with rank and select."""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"WVM1"
# Bits between two stored ranks of a plane.
BLOCK_BITS = 512
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """Token access, counting and occurrence lookup on packed bit planes.

    Plane ``p`` holds bit ``levels - 1 - p`` of every token in the order that the
    planes above leave: tokens with a 0 first, then those with a 1, each in their
    former order. Every BLOCK_BITS bits the ones so far are stored.
    """

    def __init__(self, length: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.length, self.zeros, self.planes, self.ranks = length, zeros, planes, ranks

    @property
    def levels(self) -> int:
        return len(self.planes)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids)
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        order = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for level in range(levels - 1, -1, -1):
            ones = (order & order.dtype.type(1 << level)) != 0
            packed = np.packbits(ones, bitorder="little")
            planes.append(packed)
            ranks.append(_block_ranks(packed))
            zeros.append(len(order) - int(np.count_nonzero(ones)))
            if level:  # the last plane's order is not needed
                order = np.concatenate([np.compress(~ones, order), np.compress(ones, order)])
        return cls(len(ids), zeros, planes, ranks)

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack(f"<QI{self.levels}Q", self.length, self.levels, *self.zeros)
        body = b"".join(r.astype("<u4").tobytes() + p.tobytes() for p, r in zip(self.planes, self.ranks))
        return head + body

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> WaveletMatrix:
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet matrix")
        length, levels = struct.unpack_from("<QI", data, 4)
        zeros = list(struct.unpack_from(f"<{levels}Q", data, 16))
        at, size = 16 + 8 * levels, (length + 7) // 8
        blocks = _n_blocks(size)
        planes, ranks = [], []
        for _ in range(levels):
            ranks.append(np.frombuffer(data, "<u4", blocks, at))
            planes.append(np.frombuffer(data, np.uint8, size, at + 4 * blocks))
            at += 4 * blocks + size
        return cls(length, zeros, planes, ranks)

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i >> 3]) >> (i & 7) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK_BITS
        packed, first, last = self.planes[plane], block * (BLOCK_BITS // 8), i >> 3
        n = int(self.ranks[plane][block]) + int(_POPCOUNT[packed[first:last]].sum())
        return n + (bin(int(packed[last]) & (1 << (i & 7)) - 1).count("1") if i & 7 else 0)

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        token = 0
        for plane in range(self.levels):
            bit = self._bit(plane, i)
            token = token << 1 | bit
            ones = self._ones(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
        return token

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences in [start, stop) stand after the last plane."""
        if token < 0 or token >> self.levels:
            return 0, 0
        for plane in range(self.levels):
            a, b = self._ones(plane, start), self._ones(plane, stop)
            if token >> (self.levels - 1 - plane) & 1:
                start, stop = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often a token occurs in [start, stop)."""
        first, last = self._range(token, start, self.length if stop is None else stop)
        return last - first

    def select(self, token: int, k: int) -> int:
        """Position of the token's occurrence number ``k``, from 0."""
        first, last = self._range(token, 0, self.length)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for plane in range(self.levels - 1, -1, -1):
            if token >> (self.levels - 1 - plane) & 1:
                i = self._select_bit(plane, i - self.zeros[plane], True)
            else:
                i = self._select_bit(plane, i, False)
        return i

    def _select_bit(self, plane: int, k: int, one: bool) -> int:
        ranks = self.ranks[plane].astype(np.int64)
        if not one:
            ranks = np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        size = BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[plane][block * size : (block + 1) * size], bitorder="little")
        hits = np.flatnonzero(bits == one)
        return block * BLOCK_BITS + int(hits[k - int(ranks[block])])

    def decode(self) -> np.ndarray:
        """Every token, as unsigned 32-bit integers."""
        n = self.length
        kind = np.uint16 if self.levels <= 16 else np.uint32
        tokens = np.zeros(n, kind)
        for plane in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane], count=n, bitorder="little").view(bool)
            zeros, restored = self.zeros[plane], np.empty(n, kind)
            restored[np.flatnonzero(~ones)] = tokens[:zeros]
            restored[np.flatnonzero(ones)] = tokens[zeros:] | kind(1 << (self.levels - 1 - plane))
            tokens = restored
        return tokens.astype("<u4")


def _n_blocks(size: int) -> int:
    return size // (BLOCK_BITS // 8) + 1


def _block_ranks(packed: np.ndarray) -> np.ndarray:
    step = BLOCK_BITS // 8
    blocks = _n_blocks(len(packed))
    whole = np.zeros(blocks * step, np.uint8)
    whole[: len(packed)] = packed
    sums = np.bitwise_count(whole.view(np.uint64)).reshape(blocks, step // 8).sum(axis=1, dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(sums)[:-1]]).astype(np.uint32)
