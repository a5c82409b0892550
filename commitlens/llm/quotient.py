"""Counting quotient filters over packed word-id n-grams: lossless, compact, mergeable counters.

An n-gram of up to three word ids (0 stands for no word) is packed into ``3 * width`` bits, kept as two halves. A Feistel
network permutes the packed value: it can be inverted and spreads any set of n-grams evenly. Of the permuted value, the
top bits are the *range* (which merges belong together), the next ones the *quotient*, and all others the *remainder*.
Nothing is hashed away, so counts are exact and every n-gram can be read back.

A filter holds one slot for each distinct n-gram in the order of the permuted values, so quotients need no storage of
their own: one bit for each quotient says whether it occurs, one bit for each slot whether it ends its quotient's run. Slots
hold the remainder in whole bytes and a one-byte counter; larger counts follow in a list of their own. Filters of one range
are sorted by the same order, so they merge by adding the counters of equal slots.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from commitlens.llm.common import mix

#: Constants of the Feistel rounds, alternately applied to the halves.
ROUNDS = tuple(np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1) for k in (1, 2, 3, 4))
#: The counter byte of slots whose count is in the list of large counts.
LARGE = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _u(n: int) -> np.uint64:
    return np.uint64(n)


@dataclass(frozen=True)
class Layout:
    """Bits of a word id and of the range number. Ids of up to 32 bits keep each half within 64 bits."""

    width: int
    range_bits: int

    def __post_init__(self):
        if not 1 <= self.width <= 32 or not 0 <= self.range_bits <= self.half:
            raise ValueError("word ids have 1 to 32 bits, and the range is part of the first half")

    @property
    def half(self) -> int:
        return -(-3 * self.width // 2)

    def pack(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of the n-grams' bits: ids as uint64 arrays."""
        low = self.half - self.width                     # bits of the second id that are in the right half
        left = (first << _u(self.width - low)) | (second >> _u(low))
        return left, ((second & _mask(low)) << _u(self.width)) | third

    def unpack(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = self.half - self.width
        high = self.width - low
        return (left >> _u(high), ((left & _mask(high)) << _u(low)) | (right >> _u(self.width)),
                right & _mask(self.width))

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k, c in enumerate(ROUNDS):
            if k % 2:
                left = left ^ (mix(right + c) & _mask(self.half))
            else:
                right = right ^ (mix(left + c) & _mask(self.half))
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(range(len(ROUNDS))):
            if k % 2:
                left = left ^ (mix(right + ROUNDS[k]) & _mask(self.half))
            else:
                right = right ^ (mix(left + ROUNDS[k]) & _mask(self.half))
        return left, right

    def ranges(self, left: np.ndarray) -> np.ndarray:
        return left >> _u(self.half - self.range_bits) if self.range_bits else np.zeros(len(left), np.uint64)


def add_up(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort permuted values and add the counts of equal ones. Sorted runs are merged, not sorted again."""
    if not len(left):
        return left, right, counts
    if 2 * half <= 64:
        order = np.argsort((left << _u(half)) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    head = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    return left[head], right[head], np.add.reduceat(counts, head)


def encode(layout: Layout, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of sorted, distinct permuted values of one range."""
    n = len(left)
    bits = min(max(n.bit_length() - 1, 0), layout.half - layout.range_bits)
    rest = layout.half - layout.range_bits - bits       # bits of the left half below the quotient
    quotient = (left >> _u(rest)) & _mask(bits)
    occupied = np.zeros(1 << bits, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)[:n]
    small, large = (left & _mask(rest)).astype("<u8"), right.astype("<u8")
    slots = np.concatenate([small.view(np.uint8).reshape(n, 8)[:, :-(-rest // 8)],
                            large.view(np.uint8).reshape(n, 8)[:, :-(-layout.half // 8)]], axis=1)
    big = counts >= LARGE
    head = np.array([n, bits], "<u4")
    return b"".join([head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), slots.tobytes(),
                     np.where(big, LARGE, counts).astype(np.uint8).tobytes(), counts[big].astype("<u8").tobytes()])


def decode(layout: Layout, number: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The permuted values and counts of a filter of range ``number``."""
    n, bits = (int(x) for x in np.frombuffer(data, "<u4", 2))
    rest = layout.half - layout.range_bits - bits
    at = 8

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    occupied = np.unpackbits(take(-(-(1 << bits) // 8)), count=1 << bits)
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(ends) - ends                         # runs ended before this slot
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    a, b = -(-rest // 8), -(-layout.half // 8)
    slots = take(n * (a + b)).reshape(n, a + b)
    wide = np.zeros((2, n, 8), np.uint8)
    wide[0, :, :a], wide[1, :, :b] = slots[:, :a], slots[:, a:]
    small, right = wide.view("<u8").reshape(2, n).astype(np.uint64)
    counts = take(n).astype(np.int64)
    counts[counts == LARGE] = np.frombuffer(data, "<u8", -1, at).astype(np.int64)
    left = (_u(number) << _u(layout.half - layout.range_bits)) if layout.range_bits else _u(0)
    return left | (quotient << _u(rest)) | small, right, counts


def merge(layout: Layout, number: int, filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Permuted values and added counts of several filters of one range."""
    parts = [decode(layout, number, x) for x in filters]
    return add_up(*(np.concatenate([p[k] for p in parts]) for k in range(3)), layout.half)
