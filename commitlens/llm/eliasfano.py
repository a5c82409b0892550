"""Elias-Fano coded monotone sequences and quantised values, in files that are memory-mapped while they are read."""

from __future__ import annotations

import tempfile

import numpy as np


def mapped(array: np.ndarray) -> np.ndarray:
    """A read-only memory map of the array's bytes in an unnamed temporary file, which goes with the map."""
    if not array.nbytes:
        return array
    with tempfile.TemporaryFile() as f:
        array.tofile(f)
        f.flush()
        return np.memmap(f, array.dtype, "r", shape=array.shape)


class EliasFano:
    """A non-decreasing sequence of non-negative integers in about ``2 + log2(universe / n)`` bits each.

    The low ``l`` bits of the values are packed; their high parts are unary in a bit vector, with the place of every
    ``BLOCK``-th set bit sampled. Reading decodes one block at a time.
    """

    BLOCK = 1 << 15

    def __init__(self, values: np.ndarray):
        values = values.astype(np.int64)
        self.n = n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        self.l = max(0, (universe // max(n, 1)).bit_length() - 1)
        high = (values >> self.l) + np.arange(n)
        upper = np.zeros((int(high[-1]) + 8) // 8 if n else 0, np.uint8)
        np.bitwise_or.at(upper, high >> 3, (np.uint8(128) >> (high & 7).astype(np.uint8)))
        self.samples = high[::self.BLOCK].copy()
        planes = [np.packbits(((values[a:a + self.BLOCK, None] >> np.arange(self.l)) & 1).astype(np.uint8).ravel())
                  for a in range(0, n, self.BLOCK)] if self.l else []
        self.low = mapped(np.concatenate(planes)) if planes else np.zeros(0, np.uint8)
        self.upper = mapped(upper)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.upper.nbytes + self.samples.nbytes

    def block(self, b: int) -> np.ndarray:
        """Values ``[b * BLOCK, (b + 1) * BLOCK)``."""
        first, count = b * self.BLOCK, min(self.BLOCK, self.n - b * self.BLOCK)
        start = int(self.samples[b])
        stop = int(self.samples[b + 1]) if b + 1 < len(self.samples) else 8 * len(self.upper)
        bits = np.unpackbits(np.asarray(self.upper[start >> 3:(stop + 7) >> 3]))
        ones = np.flatnonzero(bits[start & 7:])[:count] + start
        values = (ones - np.arange(first, first + count)) << self.l
        if self.l:
            width = (self.BLOCK * self.l) // 8
            packed = np.asarray(self.low[b * width:b * width + (count * self.l + 7) // 8])
            planes = np.unpackbits(packed)[:count * self.l].reshape(count, self.l).astype(np.int64)
            values |= (planes << np.arange(self.l)).sum(axis=1)
        return values

    def blocks(self):
        """``(first index, values)`` of every block in order."""
        for b in range(len(self.samples)):
            yield b * self.BLOCK, self.block(b)

    def take(self, index: np.ndarray) -> np.ndarray:
        """Values at ascending indexes."""
        out = np.zeros(len(index), np.int64)
        cuts = np.searchsorted(index, np.arange(len(self.samples) + 1) * self.BLOCK)
        for b in range(len(self.samples)):
            if cuts[b + 1] > cuts[b]:
                part = slice(cuts[b], cuts[b + 1])
                out[part] = self.block(b)[index[part] - b * self.BLOCK]
        return out

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Index of the first value that is at least ``wanted`` (ascending), the length where there is none."""
        out = np.full(len(wanted), self.n, np.int64)
        at = 0
        for first, values in self.blocks():
            stop = at + int(np.searchsorted(wanted[at:], values[-1], "right"))
            out[at:stop] = first + np.searchsorted(values, wanted[at:stop])
            at = stop
            if at == len(wanted):
                break
        return out


class Quantised:
    """Real values as 16-bit codes on a grid from ``low`` to ``top``; the caller names it, so that every shard rounds a value
    alike, to half a step at most."""

    def __init__(self, values: np.ndarray, low: float, top: float):
        self.low, self.step = low, max(top - low, 1e-9) / 0xFFFF
        self.codes = mapped(np.rint((values - low) / self.step).astype(np.uint16))

    def take(self, index: np.ndarray) -> np.ndarray:
        return self.low + np.asarray(self.codes[index]) * self.step
