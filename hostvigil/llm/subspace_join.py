"""All pairs of embeddings with a cosine at or above a threshold, by a filter in a subspace.

Unit vectors are rotated at random and cut into blocks of few dimensions. The first half of the
blocks is a subspace: a vector's shadow is its coordinates there and the length of all that is left.
By the Cauchy-Schwarz inequality shadows have a product at least as large as the vectors' own, so
every pair at or above the threshold is among those whose shadows are; for them the cosine of the
original vectors in double precision decides. Products of shadows are taken in single precision
and compared with the threshold less than what rounding can take off.

Equal vectors are joined as one, with their number as weight. Distinct vectors are written once, in
packs of one length and some megabytes; those of a partition have been compared with each other
before. Then a task of a Cartesian product gets two partitions of packs and compares every pack of
one with every pack of the other: nothing is copied for that, so what is kept on disk grows with the
input. Vectors of one length are joined with each other, every length under a rotation of its own.

Within a pair of packs vectors are dealt to cells, one around each of some pivots, and a cell to
chunks of bounded size. A pair of two cells has to cross their border, a hyperplane, so it is no
nearer than the distances of both to the border together: chunks, and vectors of a chunk, that are
too far from the border for any pair are left out. Chunks are compared by matrix products. Tasks
return one row for each vector that has links, with their number. What is connected within a
partition counts as one when partitions are compared, and a pair of packs returns links enough to
connect what is connected, at most one fewer than there are such groups. So a large group of near
vectors costs a row for each of its vectors and partitions, and few links.

The pivots are a few vectors of a pack and decide speed only, never results. For vectors without any
structure no exact join is cheaper than comparing a fixed share of all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import flat_lists, pinned, release_memory, starts_of
from hostvigil.llm.components import connected_components

#: Vectors in a chunk of a cell.
CHUNK = 1500
#: Bytes of vectors in a pack, and in a partition of packs.
PACK_BYTES, PARTITION_BYTES = 4 << 20, 64 << 20
#: Rows of a chunk that are multiplied at once; candidates that are verified together.
ROWS, CANDIDATES = 256, 200_000
#: Room for rounding in distances from borders; candidates are verified by their cosine.
SLACK = 1e-6
COLUMNS = ("ids", "weights", "links", "labels", "vectors")
PACK = "dims int, " + ", ".join(f"{name} binary" for name in COLUMNS)
PART = "first long, second long, links long"


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, width: int) -> list[tuple[int, int]]:
    """Where the blocks begin and end."""
    return [(a, min(a + width, dims)) for a in range(0, dims, width)]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, whatever their magnitude."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def key_of(dims: int, vector: bytes) -> bytes:
    """The same for equal vectors; 128 bits of a cryptographic hash, so no two others share it."""
    return hashlib.blake2b(dims.to_bytes(4, "little") + vector, digest_size=16).digest()


def packed(vectors: np.ndarray) -> list[bytes]:
    """Vectors in single precision if that holds all of one, else in double."""
    dims, out = vectors.shape[1], [b""] * len(vectors)
    with np.errstate(over="ignore", under="ignore"):
        single = vectors.astype("<f4")
    holds = (single == vectors).all(axis=1)
    for rows, values in ((holds, single), (~holds, vectors.astype("<f8"))):
        size, data = dims * values.itemsize, values[rows].tobytes()
        for at, k in enumerate(np.flatnonzero(rows).tolist()):
            out[k] = data[at * size : at * size + size]
    return out


def read_vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, list[bytes]]]:
    """Rows of a batch that have a vector to compare, by its length, and their vectors."""
    values, lengths = flat_lists(batch["e"])
    starts, known = starts_of(lengths), batch["vec_id"].is_valid().to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero((lengths == dims) & known)
        # -0.0 and 0.0 are one number.
        vectors = values[starts[rows][:, None] + np.arange(dims)] + values.dtype.type(0)
        good = np.isfinite(vectors).all(axis=1) & vectors.any(axis=1)
        yield rows[good], dims, packed(vectors[good])


def with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dims, vector of the rows that have one."""
    for batch in batches:
        for rows, dims, vectors in read_vectors(batch):
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(pa.array(rows)), pa.array(np.full(len(rows), dims, np.int32)),
                 pa.array(vectors, pa.binary())], ["vec_id", "dims", "vector"])


def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id of every row, key of those that have a vector."""
    for batch in batches:
        keys: list[bytes | None] = [None] * batch.num_rows
        for rows, dims, vectors in read_vectors(batch):
            for k, vector in zip(rows.tolist(), vectors, strict=True):
                keys[k] = key_of(dims, vector)
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array(keys, pa.binary())], ["vec_id", "key"])


def out_of_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, rep, others (equal or linked within the partition) of every vector of some packs."""
    for batch in batches:
        for k in range(batch.num_rows):
            dims, data = batch["dims"][k].as_py(), batch["vectors"][k].as_py()
            ids, weights, links = (
                np.frombuffer(batch[c][k].as_buffer(), "<i8") for c in ("ids", "weights", "links"))
            size, others = len(data) // len(ids), links + weights - 1
            for at in range(0, len(ids), 10_000):
                keys = [key_of(dims, data[i * size : i * size + size])
                        for i in range(at, min(at + 10_000, len(ids)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(ids[at : at + 10_000]),
                     pa.array(others[at : at + 10_000])], ["key", "rep", "others"])


def labels_of_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between vectors and what they are connected with in their partition."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, labels = (np.frombuffer(batch[c][k].as_buffer(), "<i8") for c in ("ids", "labels"))
            other = ids != labels
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[other]), pa.array(labels[other])], ["a", "b"])


class Pack:
    """Some vectors of one length: ids, weights, labels, and the vectors themselves."""

    def __init__(self, dims: int, ids, weights, labels, vectors) -> None:
        self.ids, self.weights, self.labels = (
            np.frombuffer(x, "<i8") for x in (ids, weights, labels))
        values = np.frombuffer(vectors, "<f4" if len(vectors) == 4 * dims * len(self.ids) else "<f8")
        self.exact = unit(values.reshape(-1, dims).astype(np.float64))

    def deal(self, centres: np.ndarray, chunk: int) -> None:
        """Deal the vectors to the nearest of some centres, and these cells to chunks.

        ``chunks`` has the cell and the places of every chunk, ``edge`` the distance of every
        vector from the border of its cell with every other.
        """
        far = 2 - 2 * (self.exact @ centres.T)
        home = far.argmin(axis=1)
        apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))[home]
        # Centres that are nearly one have no border that rounding leaves in its place.
        self.edge = np.where(apart > 0.01, (far - far[np.arange(len(home)), home][:, None])
                             / (2 * np.maximum(apart, 0.01)), 0)
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(len(centres)), "right").tolist()
        self.chunks = [
            (cell, order[at : min(at + chunk, end)])
            for cell, (begin, end) in enumerate(zip([0, *ends], ends, strict=False))
            for at in range(begin, end, chunk)]

    def cast(self, turn: np.ndarray) -> None:
        """Take shadows in the subspace that some columns of a rotation span."""
        head = self.exact @ turn
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", head, head), 0))
        self.shadow = np.concatenate([head, rest[:, None]], axis=1).astype(np.float32)


class Products:
    """Products of shadows, in memory that is used again."""

    def __init__(self, rows: int, columns: int) -> None:
        self.room, self.mask = np.empty(rows * columns, np.float32), np.empty(rows * columns, bool)

    def at_least(
        self, rows: np.ndarray, columns: np.ndarray, floor: np.float32,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns whose product reaches a floor; few do, so eight are seen at once."""
        size, whole = len(rows) * len(columns), len(rows) * len(columns) // 8 * 8
        room, mask = self.room[:size], self.mask[:size]
        np.matmul(rows, columns.T, out=room.reshape(len(rows), len(columns)))
        np.greater_equal(room, floor, out=mask)
        eights = np.flatnonzero(mask[:whole].view(np.uint64) != 0)
        places = np.concatenate([(eights[:, None] * 8 + np.arange(8)).ravel(),
                                 np.arange(whole, size)])
        return np.divmod(places[mask[places]], len(columns))


def connect(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Give the ends of links one label; a label is the least place that has it."""
    while True:
        a, b = label[p], label[q]
        apart = a != b
        if not apart.any():
            return
        p, q = p[apart], q[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label != (further := label[label])).any():
            label[:] = further


class Comparer:
    """Finds the links between two packs, or within one."""

    def __init__(self, cosine: float, width: int, pivots: int, seed: int, chunk: int) -> None:
        self.cosine, self.pivots, self.chunk = cosine, pivots, chunk
        self.width, self.seed, self.dims = width, seed, 0
        self.products = Products(ROWS, chunk)
        self.reach = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK

    def subspace(self, dims: int) -> np.ndarray:
        """The columns of the rotation that span the first half of the blocks."""
        if dims != self.dims:
            blocks = blocks_of(dims, self.width)
            self.turn = rotation(dims, self.seed)[:, : blocks[(len(blocks) - 1) // 2][1]]
            self.dims = dims
        return self.turn

    def compare(
        self, left: Pack, right: Pack, links: tuple[np.ndarray, np.ndarray],
        tie: Callable[[np.ndarray, np.ndarray], None],
    ) -> None:
        """Add the weights of what is linked to ``links``, and call ``tie`` with the links' ends."""
        same, dims = left is right, left.exact.shape[1]
        turn, step = self.subspace(dims), max(1, 2_000_000 // dims)
        # Twice what rounding can take off a product of unit vectors, and more.
        floor = np.float32(self.cosine - (turn.shape[1] + 16) * 1.2e-7)
        if not hasattr(left, "shadow"):
            left.cast(turn)
            left.centres = left.exact[: self.pivots]
            left.deal(left.centres, self.chunk)
        if not same:
            right.cast(turn)
            right.deal(left.centres, self.chunk)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def verify() -> None:
            if not found:
                return
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            found.clear()
            for at in range(0, len(i), step):
                p, q = i[at : at + step], j[at : at + step]
                near = np.einsum("ij,ij->i", left.exact[p], right.exact[q]) >= self.cosine
                p, q = p[near], q[near]
                np.add.at(links[0], p, right.weights[q])
                np.add.at(links[1], q, left.weights[p])
                tie(p, q)

        for first, (cell, here) in enumerate(left.chunks):
            for second, (other, there) in enumerate(right.chunks):
                if same and second < first:
                    continue
                p, q = here, there
                if cell != other:
                    near_p, near_q = left.edge[p, other], right.edge[q, cell]
                    p, q = (p[near_p + near_q.min() <= self.reach],
                            q[near_q + near_p.min() <= self.reach])
                columns = right.shadow[q]
                for at in range(0, len(p) if len(q) else 0, ROWS):
                    rows = p[at : at + ROWS]
                    i, j = self.products.at_least(left.shadow[rows], columns, floor)
                    if same and second == first:
                        once = i + at < j
                        i, j = i[once], j[once]
                    if len(i):
                        found.append((rows[i], q[j]))
                        if sum(len(x) for x, _ in found) >= CANDIDATES:
                            verify()
        verify()

    def into_packs(
        self, batches: Iterator[pa.RecordBatch], most: int
    ) -> Iterator[pa.RecordBatch]:
        """Packs of the rows (dims, vector, rep, weight) of a partition, compared with each other.

        ``links`` are those within the partition. ``labels`` are the same for what they connect:
        the least id there.
        """
        held: dict[tuple[int, int], list[tuple[bytes, bytes, bytes]]] = {}
        packs: dict[int, list[tuple[bytes, bytes, bytes]]] = {}

        def close(dims: int, size: int) -> None:
            parts = zip(*held.pop((dims, size)), strict=True)
            packs.setdefault(dims, []).append(tuple(b"".join(x) for x in parts))

        for batch in batches:
            vectors = batch["vector"].to_pylist()
            ids, weights = (batch[c].to_numpy().astype("<i8") for c in ("rep", "weight"))
            kinds = np.stack([batch["dims"].to_numpy(), np.fromiter(map(len, vectors), np.int64)], 1)
            for dims, size in np.unique(kinds, axis=0).tolist():
                rows = np.flatnonzero((kinds == (dims, size)).all(axis=1))
                step = max(1, most // size // 4)
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    held.setdefault((dims, size), []).append((
                        ids[some].tobytes(), weights[some].tobytes(),
                        b"".join([vectors[k] for k in some.tolist()])))
                    if sum(len(x[2]) for x in held[dims, size]) > most - step * size:
                        close(dims, size)
        for dims, size in list(held):
            close(dims, size)
        for dims, all_of in packs.items():
            ids = np.frombuffer(b"".join(x[0] for x in all_of), "<i8")
            ends = np.cumsum([len(x[0]) // 8 for x in all_of])
            label, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            places = [slice(a, b) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            for k, (x, at) in enumerate(zip(all_of, places, strict=True)):
                left = Pack(dims, x[0], x[1], x[0], x[2])
                for y, to in list(zip(all_of, places, strict=True))[k:]:
                    right = left if to is at else Pack(dims, y[0], y[1], y[0], y[2])
                    self.compare(
                        left, right, (links[at], links[to]),
                        lambda p, q, at=at, to=to: connect(label, p + at.start, q + to.start))
            least = ids.copy()
            np.minimum.at(least, label, ids)
            for (own, weights, vectors), at in zip(all_of, places, strict=True):
                values = (own, weights, links[at].tobytes(), least[label[at]].tobytes(), vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dims], pa.int32()), *(pa.array([x], pa.binary()) for x in values)],
                    ["dims", *COLUMNS])
        release_memory()

    def between(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between the packs of two partitions.

        Rows (id, null, number of links), and rows (a, b, 0) that connect labels.
        """
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        left, last = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                numbers = [batch[side + "pack"][k].as_py() for side in ("l_", "r_")]
                sides = [left if number == last else Pack(batch["l_dims"][k].as_py(), *(
                    batch[side + c][k].as_buffer() for c in ("ids", "weights", "labels", "vectors")))
                    for side, number in zip(("l_", "r_"), numbers, strict=True)]
                left, last = sides[0], numbers[0]
                for number, side in zip(numbers, sides, strict=True):
                    if number not in totals:
                        totals[number] = side.ids.copy(), np.zeros(len(side.ids), np.int64)
                names, node = np.unique(np.concatenate([s.labels for s in sides]),
                                        return_inverse=True)
                label, shift = np.arange(len(names)), len(left.ids)
                self.compare(*sides, (totals[numbers[0]][1], totals[numbers[1]][1]),
                             lambda p, q, label=label, node=node, shift=shift:
                             connect(label, node[p], node[q + shift]))
                tied = np.flatnonzero(label != np.arange(len(label)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[tied]), pa.array(names[label[tied]]),
                     pa.array(np.zeros(len(tied), np.int64))], ["first", "second", "links"])
        for ids, links in totals.values():
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some])],
                ["first", "second", "links"])
        release_memory()


def similar_vectors(
    vectors: DataFrame, cosine: float = 0.9, width: int = 16, pivots: int = 24, seed: int = 11,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows at or above the cosine. ``component_id`` is the least vec_id
    that links reach, ``kept`` says that it is the row's own. Vectors link with vectors of their own
    length only. Vectors that are null, empty, zero or hold a null or non-finite component have no
    links. Rows with a null vec_id count as no vector and come back with no links and a null
    component. Rows that repeat an id count as vectors of their own in ``n_links``. No rows give no
    rows; other columns than vec_id and embedding are not looked at.

    The driver gets no vectors.
    """
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("e"))
    comparer, most = (cosine, width, pivots, seed, CHUNK), PACK_BYTES
    size = rows.agg(F.sum(F.when(F.size("e") > 0, F.size("e").cast("long")))).first()[0] or 0
    size *= 4 if single else 8
    # Tasks enough for all cores, from partitions that are not too small.
    spread = min(math.ceil(math.sqrt(12 * spark.sparkContext.defaultParallelism)), size >> 20)
    partitions = max(1, spread, math.ceil(size / PARTITION_BYTES))
    distinct = (
        rows.mapInArrow(with_vectors, "vec_id long, dims int, vector binary")
        .groupBy("dims", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    )
    packs = pinned(
        distinct.coalesce(partitions)
        .mapInArrow(lambda batches: Comparer(*comparer).into_packs(batches, most), PACK)
        .select("*", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("pack"))
    )
    left, right = (
        packs.drop("links").select(*(F.col(c).alias(side + c) for c in packs.columns if c != "links"))
        for side in ("l_", "r_"))
    # Of one length, but not as an equality, by which Spark would deal all packs of it to one task.
    met = pinned(
        left.join(right.hint("shuffle_replicate_nl"),
                  F.expr("l_dims <= r_dims and l_dims >= r_dims and l_part < r_part"))
        .mapInArrow(lambda batches: Comparer(*comparer).between(batches), PART)
    )
    counts = met.filter("second is null").groupBy(F.col("first").alias("rep")).agg(
        F.sum("links").alias("links"))
    components = connected_components(
        met.filter("second is not null").select(F.col("first").alias("a"), F.col("second").alias("b"))
        .unionAll(packs.select("ids", "labels").mapInArrow(labels_of_packs, "a long, b long")))
    by_vector = (
        packs.select("dims", "ids", "weights", "links", "vectors")
        .mapInArrow(out_of_packs, "key binary, rep long, others long")
        .join(counts, "rep", "left")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("others")).alias("links"),
                F.coalesce("component", "rep").alias("component"))
    )
    return (
        rows.mapInArrow(with_keys, "vec_id long, key binary").join(by_vector, "key", "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
