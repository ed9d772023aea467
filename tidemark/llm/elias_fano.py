"""Elias-Fano code of a non-decreasing sequence, with select in near-minimal space.

``n`` values below ``u`` take ``n * floor(log2(u / n))`` low bits and at most ``2 n`` + ``u / 2^l``
high bits. Each value's high part is a one in a unary bit vector; a directory holds the number of
ones before every 512 bits as 32-bit counts, and ``select`` finds the block there, then the bit.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"TEF1"
BLOCK = 512
_HEAD = struct.Struct("<4sIQB3x")


def encode(values: np.ndarray) -> bytes:
    """Bytes of the sequence ``values`` (non-negative, non-decreasing)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
    low = values & np.uint64((1 << low_bits) - 1)
    shifts = np.arange(low_bits, dtype=np.uint64)
    low_part = np.packbits(((low[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
    places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    blocks = (int(places[-1]) // BLOCK + 1) if n else 0
    high = np.zeros(blocks * BLOCK, np.uint8)
    high[places] = 1
    ones = high.reshape(-1, BLOCK).sum(axis=1) if blocks else np.zeros(0)
    directory = (np.cumsum(ones) - ones).astype("<u4")
    return b"".join(
        (_HEAD.pack(MAGIC, n, top, low_bits), struct.pack("<I", blocks), directory.tobytes(),
         np.packbits(high, bitorder="little").tobytes(), low_part.tobytes())
    )


class EliasFano:
    """Reads the bytes in place."""

    def __init__(self, data: bytes):
        magic, self.n, self.top, self.low_bits = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        at = _HEAD.size
        (blocks,) = struct.unpack_from("<I", data, at)
        at += 4
        self.directory = np.frombuffer(data, "<u4", blocks, at)
        at += 4 * blocks
        self.high = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
        at += blocks * BLOCK // 8
        self.low = np.frombuffer(data, np.uint8, (self.n * self.low_bits + 7) // 8, at)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The ``i``-th value, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        b = int(np.searchsorted(self.directory, i, "right")) - 1
        bits = np.unpackbits(self.high[b * BLOCK // 8 : (b + 1) * BLOCK // 8], bitorder="little")
        place = b * BLOCK + int(np.flatnonzero(bits)[i - int(self.directory[b])])
        return (place - i) << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        raw = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little")
        return raw >> first % 8 & (1 << self.low_bits) - 1

    def values(self) -> np.ndarray:
        """All values at once (uint64), as select gives them one by one."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits)
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= bits.reshape(self.n, -1).astype(np.uint64) @ weights
        return out
