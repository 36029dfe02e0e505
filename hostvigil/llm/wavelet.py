"""A wavelet matrix over the classes of a text's bytes, queried for many positions at once."""

from __future__ import annotations

import numpy as np

#: Classes of UTF-8 bytes; three bits tell them apart.
CONTINUATION, WORD, BLANK, LINE, MARK, LEAD2, LEAD3, LEAD4 = range(8)
LEVELS = 3


def _class_table() -> np.ndarray:
    byte = np.arange(256)
    table = np.full(256, MARK, np.uint8)
    letters = ((byte | 32) >= ord("a")) & ((byte | 32) <= ord("z")) & (byte < 128)
    table[letters | ((byte >= ord("0")) & (byte <= ord("9"))) | (byte == ord("_"))] = WORD
    table[[ord(" "), ord("\t")]] = BLANK
    table[ord("\n")] = LINE
    for least, kind in ((0x80, CONTINUATION), (0xC0, LEAD2), (0xE0, LEAD3), (0xF0, LEAD4)):
        table[least:] = kind
    return table


CLASSES = _class_table()


class BitRanks:
    """A bit vector that counts its ones before any position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        # One word more than needed, so that the end is a position like any other.
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Rank of every byte class before any position, in one bit vector per level.

    A level sorts the bytes stably by one bit of their class, highest bit first, so a class's
    bytes before a position stay consecutive from level to level and their number is the distance
    between two mapped positions.
    """

    def __init__(self, data: np.ndarray):
        classes = CLASSES[data]
        self.size = len(classes)
        self.levels = []
        for shift in range(LEVELS - 1, -1, -1):
            bits = (classes >> shift) & 1
            self.levels.append(BitRanks(bits))
            one = bits.astype(bool)
            classes = np.concatenate([classes[~one], classes[one]])

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How many bytes of a class stand before each position."""
        low, high = np.zeros(1, np.int64), at
        for level, bits in enumerate(self.levels):
            ones = kind >> (LEVELS - 1 - level) & 1
            low, high = (
                (bits.zeros + bits.ones(p)) if ones else (p - bits.ones(p)) for p in (low, high)
            )
        return high - low

    def count(self, kinds: frozenset[int], at: np.ndarray) -> np.ndarray:
        """How many bytes of any of some classes stand before each position."""
        rest = frozenset(range(1 << LEVELS)) - kinds
        if len(rest) < len(kinds):
            return at - self.count(rest, at)
        total = np.zeros(len(at), np.int64)
        for kind in kinds:
            total += self.rank(kind, at)
        return total

    def locate(
        self, kinds: frozenset[int], target: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> np.ndarray:
        """The first position from ``low`` on with at least ``target`` such bytes before it.

        By bisection on ranks; ``high`` where there are fewer.
        """
        low, high = low.copy(), high.copy()
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            enough = self.count(kinds, middle) >= target
            open_ = low < high
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return high
