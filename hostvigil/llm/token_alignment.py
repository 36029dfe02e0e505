"""Alignment of two tokenizers' tokens, scored by how often token pairs are linked corpus-wide.

A link is a pair of token occurrences, one of each tokenizer, whose byte ranges overlap. Every task
tokenises its texts and gathers an inverted index: per id pair the compressed bitmap of the
documents that hold it, with planes for repeated links (see ``pair_bitmaps``), OR-merged over the
slices of a chunk of documents. Popcounts of these are summed per pair, before and after one small
shuffle; the sums go back to the chunks, whose postings then hand every document its scores. No
row per (document, pair) is ever shuffled and no group outgrows a chunk.

Texts are cut before blanks that follow a visible character. Neither kind of tokenizer has a token
that spans such a place, so each different piece is tokenised and aligned once per worker memory.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import ranges, release_memory, shared_folder, slices, starts_of
from hostvigil.llm.pair_bitmaps import (
    ID_BITS,
    SLOTS,
    Chunk,
    cardinality,
    members,
    pair_of,
    total,
)

#: Pieces of text that a task remembers; beyond it only the third seen most often is kept.
REMEMBERED = 200_000
#: Pieces that are tokenised as one text.
JOINED = 64
#: Bytes of text aligned at a time, and (pair, document) numbers that close a chunk.
SLICE_BYTES = 1 << 20
CHUNK_NUMBERS = 2_500_000

_MAPPED = (
    "chunk long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pair long, documents binary, planes array<binary>"
)
_SUMMARY = ("doc_id", "n_a", "n_b", "n_groups", "n_links")


class ByteLevel:
    """A byte-level tokenizer read from its JSON file."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.encode_special_tokens = True
        byte_of = _byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, at in vocabulary.items():
            known = all(c in byte_of for c in entry)
            self.bytes[at] = bytes(byte_of[c] for c in entry) if known else entry.encode()

    def encode(self, pieces: list[str]) -> list[list[int]]:
        found = []
        for at in range(0, len(pieces), 4096):
            batch = self.tokenizer.encode_batch_fast(pieces[at : at + 4096], add_special_tokens=False)
            found += [x.ids for x in batch]
        return found


class Pieces:
    """A sentencepiece tokenizer that puts one blank before what it is given."""

    def __init__(self, raw: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=raw)
        size = self.model.get_piece_size()
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(k)
            else piece.replace("▁", " ").encode()
            for k, piece in ((k, self.model.id_to_piece(k)) for k in range(size))
        ]
        self.blank = self.model.piece_to_id("▁")

    def encode(self, pieces: list[str]) -> list[list[int]]:
        found = self.model.encode([x[1:] for x in pieces], num_threads=1)
        # Of nothing it makes nothing, not even the blank.
        return [ids if len(x) > 1 else [self.blank] for x, ids in zip(pieces, found, strict=True)]


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def piece_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts that lie one after another begin.

    A cut needs a character before the blank that is surely not white space: visible ASCII, or of
    the two- and three-byte ranges without any. Elsewhere pieces just grow longer.
    """
    at = np.flatnonzero(data == 0x20)
    cut = np.zeros(len(data), bool)
    cut[at[visible_before(data, at)]] = True
    cut[text_starts] = True
    return np.flatnonzero(cut)


def visible_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is surely not white space."""
    p1, p2, p3 = (np.where(at >= k, data[np.maximum(at - k, 0)], 0) for k in (1, 2, 3))
    inner = p1 >= 0x80
    visible = (p1 > 0x20) & (p1 < 0x7F)
    visible |= inner & (p2 >= 0xC3) & (p2 <= 0xDF)
    return visible | (inner & (p2 >= 0x80) & (p2 < 0xC0) & (p3 >= 0xE4) & (p3 <= 0xEE))


class Aligner:
    """Ids, links and groups of pieces of text, each different piece aligned once."""

    def __init__(self, first: ByteLevel, second: Pieces):
        self.first, self.second = first, second
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (first, second)]
        self.vocabulary = [np.frombuffer(b"".join(t.bytes), np.uint8) for t in (first, second)]
        self.at = [starts_of(x) for x in self.sizes]
        # Every id as text, followed by what may follow it; see ``_shown``.
        self.names = pa.array(
            [f"{k}{end}" for t, marks in ((first, ",|"), (second, ",;"))
             for k in range(len(t.bytes)) for end in marks],
            pa.large_string(),
        )
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.uses = np.zeros(0, np.int64)
        self.valid = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)  # tokens of either side, groups, links
        self.link_starts = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)
        self.shown_starts = np.zeros(0, np.int64)
        self.shown = np.zeros(0, np.int32)

    def keep(self, most: int) -> None:
        """Forget all but the pieces seen most often; what was seen long ago counts less and less."""
        kept = np.sort(np.argpartition(self.uses, -most)[-most:])
        names = list(self.places)  # in the order of their numbers
        self.places = {names[k]: n for n, k in enumerate(kept.tolist())}
        links, shown = self.counts[kept, 3], self.counts[kept, 0] + self.counts[kept, 1]
        self.links = self.links[ranges(self.link_starts[kept], links)]
        self.shown = self.shown[ranges(self.shown_starts[kept], shown)]
        self.link_starts, self.shown_starts = starts_of(links), starts_of(shown)
        self.counts, self.valid = self.counts[kept], self.valid[kept]
        self.uses = self.uses[kept] // 2

    def learn(self, pieces: list[str]) -> None:
        raw = [x.encode() for x in pieces]
        data = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.array([len(x) for x in raw], np.int64)
        joinable = visible_before(data, np.cumsum(lengths))
        if not joinable.all():
            order = np.argsort(~joinable, kind="stable")
            pieces = [pieces[k] for k in order.tolist()]
            data = data[ranges(starts_of(lengths)[order], lengths[order])]
            lengths = lengths[order]
        valid = np.ones(len(pieces), bool)
        flat, tokens = [], []
        for k in (0, 1):
            all_ids, n = self._encoded(k, pieces, lengths, int(joinable.sum()))
            flat.append(all_ids)
            tokens.append(n)
            valid &= self._spells(k, all_ids, n, data, lengths)
        keep = [np.repeat(valid, n) for n in tokens]
        a, b = (ids[mask] for ids, mask in zip(flat, keep, strict=True))
        tokens = [np.where(valid, n, 0) for n in tokens]
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        low = np.searchsorted(ends_b, ends_a - self.sizes[0][a], "right")
        high = np.searchsorted(ends_b, ends_a, "left")
        links = pair_of(np.repeat(a, high - low + 1), b[ranges(low, high - low + 1)])
        upto = np.concatenate([[0], np.cumsum(high - low + 1)])
        last_a = np.cumsum(tokens[0])
        n_links = upto[last_a] - upto[last_a - tokens[0]]
        # Groups end where tokens of both sides do.
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = (np.searchsorted(e, both) + 1 for e in (ends_a, ends_b))
        last = np.searchsorted(both, np.cumsum(np.where(valid, lengths, 0)), "right")
        n_groups = np.diff(last, prepend=0)
        self.places.update(zip(pieces, range(len(self.places), len(self.places) + len(pieces)),
                               strict=True))
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])
        self.valid = np.concatenate([self.valid, valid])
        self.counts = np.concatenate(
            [self.counts, np.stack([tokens[0], tokens[1], n_groups, n_links], 1)])
        self.link_starts = np.concatenate(
            [self.link_starts, len(self.links) + starts_of(n_links)])
        self.links = np.concatenate([self.links, links])
        n_shown = tokens[0] + tokens[1]
        self.shown_starts = np.concatenate(
            [self.shown_starts, len(self.shown) + starts_of(n_shown)])
        self.shown = np.concatenate(
            [self.shown, _shown(a, b, group_a, group_b, 2 * len(self.first.bytes))])

    def _encoded(
        self, k: int, pieces: list[str], lengths: np.ndarray, joinable: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces by one tokenizer, and how many each has.

        The first ``joinable`` pieces end visibly, so a text of several is cut where they are; where
        tokens do not end with the pieces all the same, these are encoded one by one.
        """
        tokenizer, sizes = (self.first, self.second)[k], self.sizes[k]
        flat, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def add(ids: list[list[int]]) -> None:
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int64, int(counts[-1].sum())))

        begins = range(0, joinable, JOINED)
        texts = ["".join(pieces[at : min(at + JOINED, joinable)]) for at in begins]
        for at, ids in zip(begins, tokenizer.encode(texts), strict=True):
            stop = min(at + JOINED, joinable)
            ids = np.array(ids, np.int64)
            ends, wanted = np.cumsum(sizes[ids]), np.cumsum(lengths[at:stop])
            last = np.searchsorted(ends, wanted, "right")
            if len(ends) and last[-1] == len(ends) and last[0] and (ends[last - 1] == wanted).all():
                flat.append(ids)
                counts.append(np.diff(last, prepend=0))
            else:
                add(tokenizer.encode(pieces[at:stop]))
        add(tokenizer.encode(pieces[joinable:]))
        return np.concatenate(flat), np.concatenate(counts)

    def _spells(self, k: int, ids: np.ndarray, n: np.ndarray, data: np.ndarray,
                lengths: np.ndarray) -> np.ndarray:
        """Whether the bytes of each piece's tokens are the piece's."""
        sizes = self.sizes[k][ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(n)
        spelled = upto[ends] - upto[ends - n]
        same = spelled == lengths
        places = np.flatnonzero(same)
        mine = self.vocabulary[k][ranges(self.at[k][ids], sizes)]
        at = ranges(upto[ends - n][places], spelled[places])
        wanted = data[ranges(starts_of(lengths)[places], lengths[places])]
        wrong = np.repeat(places, lengths[places])[mine[at] != wanted]
        same[wrong] = False
        return same

    def __call__(self, pieces: pa.Array) -> np.ndarray:
        """The numbers of pieces, those not known yet learnt first."""
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        new = [x for x in different if x not in self.places]
        most = REMEMBERED // 3
        if len(self.places) + len(new) > REMEMBERED and len(self.places) > most > 0:
            self.keep(most)
            new = [x for x in different if x not in self.places]
        if new:
            self.learn(new)
        places = np.fromiter(map(self.places.__getitem__, different), np.int64, len(different))
        indices = coded.indices.to_numpy()
        self.uses[places] += np.bincount(indices, minlength=len(places))
        return places[indices]


def _shown(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, base: int
           ) -> np.ndarray:
    """Both sides' tokens group by group, each as a place among an aligner's ``names``.

    ``ends_a`` and ``ends_b`` say where each group ends among the tokens of either side. The last
    token of a side in a group is followed by ``|`` or ``;``, the others by a comma.
    """
    of_a = np.searchsorted(ends_a, np.arange(len(a)), "right")
    of_b = np.searchsorted(ends_b, np.arange(len(b)), "right")
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[ends_a - 1] = last_b[ends_b - 1] = 1
    order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
    return np.concatenate([2 * a + last_a, base + 2 * b + last_b])[order].astype(np.int32)


def align_documents(docs: DataFrame, first_file: str, second_file: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    ``n_best`` counts the links whose pair is linked corpus-wide as often as any pair with the same
    second id, ``count_sum`` adds up the corpus-wide counts of the links. Null and empty texts and
    those whose tokens do not spell a blank and the text have no tokens, and add to no count; their
    digest is empty. A null doc_id stays null; every row is a document of its own, repeated ones
    as well; an empty table gives no rows; other columns are not looked at. Both files are read on
    the driver and broadcast; vocabularies are a few MB.
    """
    mapped = map_documents(docs, first_file, second_file)
    return scored(mapped)


def map_documents(docs: DataFrame, first_file: str, second_file: str) -> DataFrame:
    """Both the documents' own figures (``slot`` set) and their chunks' postings (``pair`` set),
    from one pass, kept in the shared folder."""
    spark = docs.sparkSession
    files = []
    for name in (first_file, second_file):
        with open(name, "rb") as f:
            files.append(f.read())
    sent = spark.sparkContext.broadcast(tuple(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevel(sent.value[0]), Pieces(sent.value[1]))
        base = TaskContext.get().partitionId() << 32
        number, used, chunk = 0, 0, Chunk()
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for low, high in slices(sizes, SLICE_BYTES):
                for at in range(low, high, SLOTS):  # short texts are many
                    n = min(high - at, SLOTS)
                    if used and (used + n > SLOTS or chunk.size >= CHUNK_NUMBERS):
                        yield from _postings(base + number, chunk)
                        number, used, chunk = number + 1, 0, Chunk()
                    yield _aligned(aligner, batch.column(0).slice(at, n),
                                   texts.take(pa.array(np.arange(at, at + n))),
                                   base + number, used, chunk)
                    used += n
                release_memory()
        if used:
            yield from _postings(base + number, chunk)
        aligner.forget()
        release_memory()

    folder = f"{shared_folder(spark)}/token-pairs-{uuid.uuid4().hex}"
    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _MAPPED
    ).write.parquet(folder)
    return spark.read.schema(_MAPPED).parquet(folder)


def _aligned(aligner: Aligner, doc_ids: pa.Array, texts: pa.Array, chunk_id: int, used: int,
             chunk: Chunk) -> pa.RecordBatch:
    """Rows of some documents; their pairs go to the chunk."""
    n = len(texts)
    raw = [(" " + x).encode() if x else b"" for x in texts.to_pylist()]
    lengths = np.array([len(x) for x in raw], np.int64)
    joined = b"".join(raw)
    data = np.frombuffer(joined, np.uint8)
    filled = np.flatnonzero(lengths)
    starts = starts_of(lengths)[filled]
    cuts = piece_starts(data, starts)
    pieces = pa.LargeStringArray.from_buffers(
        len(cuts), pa.py_buffer(np.append(cuts, len(data)).astype(np.int64)), pa.py_buffer(joined))
    codes = aligner(pieces)
    of = filled[np.searchsorted(starts, cuts, "right") - 1]
    spoiled = np.zeros(n, bool)
    spoiled[of[~aligner.valid[codes]]] = True
    codes, of = codes[~spoiled[of]], of[~spoiled[of]]
    figures = np.zeros((n, 4), np.int64)
    np.add.at(figures, of, aligner.counts[codes])
    n_links = aligner.counts[codes, 3]
    chunk.add(aligner.links[ranges(aligner.link_starts[codes], n_links)],
              np.repeat(of + used, n_links))
    n_shown = aligner.counts[codes, 0] + aligner.counts[codes, 1]
    named = aligner.names.take(
        pa.array(aligner.shown[ranges(aligner.shown_starts[codes], n_shown)]))
    # The names lie one after another in one buffer, so a document's groups are a part of it.
    upto = np.concatenate([[0], np.cumsum(n_shown)])[
        np.searchsorted(of, np.arange(n + 1), "left")]
    places, buffer = [0] * (n + 1), memoryview(b"")
    if len(named):
        places = np.frombuffer(named.buffers()[1], np.int64)[upto].tolist()
        buffer = memoryview(named.buffers()[2])
    digests = [
        hashlib.sha256(buffer[low : high - 1]).hexdigest() if high > low else ""
        for low, high in zip(places, places[1:], strict=False)
    ]
    nothing = pa.nulls(n)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, chunk_id), pa.int64()),
            pa.array(np.arange(used, used + n), pa.int32()),
            doc_ids.cast(pa.int64()),
            *(pa.array(figures[:, k], pa.int64()) for k in range(4)),
            pa.array(digests, pa.string()),
            nothing.cast(pa.int64()), nothing.cast(pa.binary()),
            nothing.cast(pa.list_(pa.binary())),
        ],
        [*_names(_MAPPED)],
    )


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _postings(chunk_id: int, chunk: Chunk) -> Iterator[pa.RecordBatch]:
    for pairs, documents, planes in chunk.sets(1 << 20):
        n = len(pairs)
        nothing = pa.nulls(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, chunk_id), pa.int64()), nothing.cast(pa.int32()),
                *(nothing.cast(pa.int64()) for _ in _SUMMARY), nothing.cast(pa.string()),
                pa.array(pairs, pa.int64()), documents, planes,
            ],
            [*_names(_MAPPED)],
        )


def pair_counts(mapped: DataFrame) -> DataFrame:
    """Per id pair: pair, b, n_documents, n_links, best (no pair with that b has more links)."""
    counts = (
        mapped.filter(F.col("pair").isNotNull())
        .select("pair", cardinality(F.col("documents")).alias("d"),
                total(F.col("documents"), F.col("planes")).alias("n"))
        .groupBy("pair")
        .agg(F.sum("d").alias("n_documents"), F.sum("n").alias("n_links"))
        .withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)))
    )
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").select(
        "pair", "b", "n_documents", "n_links", (F.col("n_links") == F.col("most")).alias("best")
    )


def scored(mapped: DataFrame) -> DataFrame:
    """The documents with the scores that their chunks' postings return."""
    postings = mapped.filter(F.col("pair").isNotNull())
    counts = pair_counts(mapped).select("pair", "n_links", "best")
    asked = postings.select(F.col("chunk").alias("asking"), F.col("pair").alias("asked"))
    answers = asked.join(counts, F.col("asked") == F.col("pair")).drop("pair")
    returned = (
        postings.select("chunk", "pair", "documents", "planes").groupBy("chunk")
        .cogroup(answers.groupBy("asking"))
        .applyInArrow(_return_scores, "chunk long, slot int, n_best long, count_sum long")
    )
    own = mapped.filter(F.col("slot").isNotNull())
    joined = own.select("chunk", "slot", *_SUMMARY, "groups_sha256").join(
        returned, ["chunk", "slot"], "left"
    )
    return joined.select(
        *_SUMMARY, "groups_sha256",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
    )


def _return_scores(postings: pa.Table, answers: pa.Table) -> pa.Table:
    """One chunk: what its documents' links score."""
    postings = postings.sort_by("pair").combine_chunks()
    answers = answers.sort_by("asked")
    weight = answers["n_links"].to_numpy()
    best = answers["best"].to_numpy().astype(np.int64)
    n_best, count_sum = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    touched = np.zeros(SLOTS, bool)

    def give(stored: pa.Array, row: np.ndarray, times: np.ndarray) -> None:
        slots, lengths = members(stored)
        row, times = np.repeat(row, lengths), np.repeat(times, lengths)
        np.add.at(n_best, slots, times * best[row])
        np.add.at(count_sum, slots, times * weight[row])
        touched[slots] = True

    if postings.num_rows:
        rows = np.arange(postings.num_rows)
        give(_one(postings["documents"]), rows, np.ones(len(rows), np.int64))
        planes = _one(postings["planes"])
        depth = planes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        bit = np.arange(int(depth.sum())) - np.repeat(starts_of(depth), depth)
        give(planes.flatten(), np.repeat(rows, depth), np.int64(1) << bit)
    slots = np.flatnonzero(touched)
    chunk = postings["chunk"][0].as_py() if postings.num_rows else 0
    return pa.table({
        "chunk": pa.array(np.full(len(slots), chunk), pa.int64()),
        "slot": pa.array(slots, pa.int32()),
        "n_best": pa.array(n_best[slots], pa.int64()),
        "count_sum": pa.array(count_sum[slots], pa.int64()),
    })


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
