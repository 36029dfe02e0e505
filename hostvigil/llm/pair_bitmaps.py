"""Compressed document bitmaps of pairs, with planes for how often a document holds a pair.

A chunk numbers its documents from 0. Per pair it has the set of documents that hold it and, for
the multiplicities beyond the first, one set per bit. A set is stored as sorted 16-bit numbers, or
as a bitmap of the whole chunk once that is smaller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Documents of a chunk; a set's bitmap has that many bits.
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
BITMAP_BYTES = SLOTS // 8
#: A pair is one number: the first id above these bits, the second below them.
ID_BITS = 20


def pair_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << ID_BITS | second.astype(np.int64)


def cardinality(stored: Column) -> Column:
    """How many documents a stored set holds."""
    return F.when(
        F.octet_length(stored) == BITMAP_BYTES, F.bitmap_count(stored)
    ).otherwise(F.octet_length(stored) / 2).cast("long")


def total(documents: Column, planes: Column) -> Column:
    """How often a chunk's documents hold a pair: the first times, and the planes by weight."""
    weighted = F.transform(planes, lambda x, bit: F.call_function("shiftleft", F.lit(1).cast("long"), bit)
                           * cardinality(x))
    return cardinality(documents) + F.aggregate(weighted, F.lit(0).cast("long"), lambda a, x: a + x)


class Chunk:
    """The pairs of some documents, gathered slice by slice."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, pairs: np.ndarray, slots: np.ndarray) -> None:
        """Occurrences of pairs in documents that no earlier slice held."""
        keys = pairs << SLOT_BITS | slots
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys.append(keys[first])
        self.counts.append(np.diff(first, append=len(keys)).astype(np.uint32))
        self.size += len(first)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """The union of the slices' sets, by pair and document, with multiplicities."""
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        keys = np.concatenate(self.keys)
        self.keys.clear()
        order = np.argsort(keys, kind="stable").astype(np.uint32)
        keys = keys[order]
        counts = np.concatenate(self.counts)[order]
        self.counts.clear()
        return keys, counts

    def sets(self, most: int) -> list[tuple[np.ndarray, pa.Array, pa.Array]]:
        """(pairs, document sets, planes) for about ``most`` document numbers at a time."""
        keys, counts = self.merged()
        pairs, slots = keys >> SLOT_BITS, (keys & (SLOTS - 1)).astype("<u2")
        begins = np.flatnonzero(np.diff(pairs, prepend=-1))
        parts = []
        low = 0
        while low < len(begins):
            high = max(low + 1, int(np.searchsorted(begins, begins[low] + most)))
            start = int(begins[low])
            stop = int(begins[high]) if high < len(begins) else len(keys)
            parts.append((
                pairs[begins[low:high]],
                stored_sets(slots[start:stop], begins[low:high] - start),
                stored_planes(slots[start:stop], counts[start:stop] - 1, begins[low:high] - start),
            ))
            low = high
        return parts


def stored_sets(slots: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Consecutive runs of sorted numbers, each as numbers or as a bitmap."""
    lengths = np.diff(begins, append=len(slots))
    dense = lengths * 2 >= BITMAP_BYTES
    if not dense.any():
        offsets = np.append(begins, len(slots)).astype(np.int32) * 2
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(begins),
            [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(slots.tobytes())],
        )
    return pa.array(
        [
            bitmap(slots[a : a + n]) if full else slots[a : a + n].tobytes()
            for a, n, full in zip(begins.tolist(), lengths.tolist(), dense.tolist(), strict=True)
        ],
        pa.binary(),
    )


def bitmap(slots: np.ndarray) -> bytes:
    bits = np.zeros(SLOTS, np.uint8)
    bits[slots] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def stored_planes(slots: np.ndarray, extra: np.ndarray, begins: np.ndarray) -> pa.Array:
    """Per run a list of sets: bit by bit, the documents whose further multiplicity has it."""
    if not len(begins):
        return pa.array([], pa.list_(pa.binary()))
    run = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(slots)))
    most = np.maximum.reduceat(extra, begins) if len(extra) else extra
    depth = np.zeros(len(begins), np.int64)
    while (left := most >> depth.astype(most.dtype)).any():
        depth += left > 0
    values: list[pa.Array] = []
    order: list[np.ndarray] = []
    for bit in range(int(depth.max(initial=0))):
        holds = np.flatnonzero(extra >> np.uint32(bit) & np.uint32(1))
        has = np.flatnonzero(depth > bit)  # a run's planes are its bits up to the highest
        at = np.searchsorted(run[holds], has)
        values.append(stored_sets(slots[holds], at))
        order.append(has * 64 + bit)
    offsets = pa.array(np.concatenate([[0], np.cumsum(depth)]).astype(np.int32))
    if not values:
        return pa.ListArray.from_arrays(offsets, pa.array([], pa.binary()))
    flat = pa.concat_arrays(values).take(pa.array(np.argsort(np.concatenate(order))))
    return pa.ListArray.from_arrays(offsets, flat)


def members(stored: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The document numbers of stored sets one after another, and how many each has."""
    if not len(stored):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stored = stored.cast(pa.binary())
    offsets = np.frombuffer(stored.buffers()[1], np.int32)[
        stored.offset : stored.offset + len(stored) + 1]
    lengths = np.diff(offsets).astype(np.int64)
    raw = np.frombuffer(stored.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    dense = lengths == BITMAP_BYTES
    if not dense.any():
        return raw.view("<u2").astype(np.int64), lengths // 2
    pieces, counts = [], lengths // 2
    ends = np.cumsum(lengths)
    at = 0
    for k in np.flatnonzero(dense).tolist():
        begin = int(ends[k]) - BITMAP_BYTES
        pieces.append(raw[at:begin].view("<u2").astype(np.int64))
        at = begin + BITMAP_BYTES
        found = np.flatnonzero(np.unpackbits(raw[begin:at], bitorder="little"))
        pieces.append(found)
        counts[k] = len(found)
    pieces.append(raw[at:].view("<u2").astype(np.int64))
    return np.concatenate(pieces), counts
