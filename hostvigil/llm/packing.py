"""Cost-balanced packing of tokenised documents into sequences of bounded length.

A piece of n tokens costs n + quadratic * n * n, the work of linear layers and of attention.
Pieces are taken by descending cost; each goes to the cheapest sequence that still has room for
it. When none has, the piece is cut to fill the roomiest sequence and its rest is queued again,
so a buffer of tokens leaves only full sequences and less than one sequence of left-over tokens,
which join the next buffer.

Every task packs the rows of its own partition, a buffer at a time: no shuffle, memory bounded by
the buffer, and a retried task finds the same pieces again as long as its input partition is the
same, as it is for files and checkpoints. What a task has left at its end becomes sequences whose
lengths are powers of two, which need no padding either.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import ranges, release_memory, slices, starts_of

SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "ids binary"
)
#: Words whose ids are remembered; beyond it the memory is emptied.
REMEMBERED = 1_200_000
#: Words encoded at a time: the tokenizer's results take some 2 KB a word until they are read.
AT_ONCE = 4096
#: Words encoded as one text, each followed by a bar: a text costs the tokenizer as much as a word.
JOINED = 64
BAR = "|"
#: Bytes of text whose different words are looked up together.
LOOKED_UP = 1 << 22


class WordIds:
    """Token ids of texts, each different word encoded once.

    Cutting at ASCII blanks first and lower-casing ASCII letters are only right for a tokenizer
    whose pre-tokenizer drops white space and that lower-cases all text. ``by_word`` says so;
    without it whole texts are encoded.
    """

    def __init__(self, tokenizer_json: str, by_word: bool):
        self.tokenizer = _loaded(tokenizer_json)
        self.by_word = by_word
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(
                texts[at : at + AT_ONCE], add_special_tokens=False)
            ids = [x.ids for x in found]
            flat.append(np.fromiter(chain.from_iterable(ids), np.uint32))
            lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        return np.concatenate(flat), np.concatenate(lengths)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode`, for texts without blanks or bars, many of them in one text."""
        bar = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        if len(bar) != 1:
            return self.encode(words)
        flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), AT_ONCE):
            some = words[at : at + AT_ONCE]
            ids, _ = self.encode([
                f" {BAR} ".join([*some[i : i + JOINED], ""]) for i in range(0, len(some), JOINED)])
            ends = np.flatnonzero(ids == bar[0])
            if len(ends) == len(some):
                flat.append(np.delete(ids, ends))
                lengths.append(np.diff(ends, prepend=-1) - 1)
            else:  # the bar's id is that of something else as well
                ids, counts = self.encode(some)
                flat.append(ids)
                lengths.append(counts)
        return np.concatenate(flat), np.concatenate(lengths)

    def remember(self, new: list[str]) -> None:
        barred = [w for w in new if BAR in w]
        plain = [w for w in new if BAR not in w] if barred else new
        new = plain + barred
        ids, lengths = map(
            np.concatenate, zip(self.encode_words(plain), self.encode(barred), strict=True))
        at, total = len(self.places), int(lengths.sum())
        if at + len(new) > len(self.starts):
            more = max(len(self.starts), len(new))
            self.starts = np.concatenate([self.starts, np.zeros(more, np.int64)])
            self.lengths = np.concatenate([self.lengths, np.zeros(more, np.int64)])
        if self.used + total > len(self.ids):
            more = max(len(self.ids), total)
            self.ids = np.concatenate([self.ids, np.zeros(more, np.uint32)])
        self.starts[at : at + len(new)] = self.used + starts_of(lengths)
        self.lengths[at : at + len(new)] = lengths
        self.ids[self.used : self.used + total] = ids
        self.used += total
        self.places.update(zip(new, range(at, at + len(new)), strict=True))

    def __call__(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text; none is null."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        if not self.by_word:
            return self.encode(texts.to_pylist())
        # A full stop or comma between an ASCII letter and a blank is a token run of its own.
        lower = pc.ascii_lower(texts.cast(pa.large_string()))
        apart = pc.replace_substring_regex(lower, r"([a-z])([.,])([ \n])", r"\1 \2\3")
        split = pc.ascii_split_whitespace(apart)
        all_words = split.flatten().dictionary_encode()
        different = all_words.dictionary.to_pylist()
        places = np.fromiter(
            map(self.places.get, different, repeat(-1)), np.int64, len(different))
        unknown = np.flatnonzero(places < 0)
        if len(self.places) + len(unknown) > REMEMBERED:
            self.forget()
            unknown = np.arange(len(different))
        new = [different[i] for i in unknown.tolist()]
        self.remember(new)
        places[unknown] = np.fromiter(map(self.places.__getitem__, new), np.int64, len(new))
        places = places[all_words.indices.to_numpy()]
        lengths = self.lengths[places]
        flat = self.ids[ranges(self.starts[places], lengths)]
        counts = split.value_lengths().to_numpy()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        return flat, upto[ends] - upto[ends - counts]


def place(lengths: list[int], capacity: int, quadratic: float) -> tuple[list, list]:
    """Where pieces of some lengths go: (piece, from, length, sequence, offset), and what is left.

    As many sequences are filled as the tokens can fill; the rest comes back as
    (piece, from, length).
    """
    sequences = sum(lengths) // capacity
    free = np.full(sequences, capacity, np.int64)
    cost = np.zeros(sequences)
    queue = [(-n, piece, 0) for piece, n in enumerate(lengths) if n]
    heapq.heapify(queue)
    placed, left = [], []
    while queue:
        negative, piece, begin = heapq.heappop(queue)
        n = -negative
        fits = free >= n
        if fits.any():
            to = int(np.where(fits, cost, np.inf).argmin())
        else:
            to = int(free.argmax()) if sequences else -1
            if to < 0 or free[to] == 0:
                left.append((piece, begin, n))
                continue
            rest = n - int(free[to])
            n -= rest
            heapq.heappush(queue, (-rest, piece, begin + n))
        placed.append((piece, begin, n, to, capacity - int(free[to])))
        free[to] -= n
        cost[to] += n + quadratic * n * n
    return placed, left


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Pieces of fewer tokens than a sequence, laid into sequences as long as powers of two."""
    total = sum(n for _, _, n in pieces)
    sizes = [1 << bit for bit in range(total.bit_length() - 1, -1, -1) if total >> bit & 1]
    placed, sequence, offset = [], 0, 0
    for piece, begin, n in pieces:
        while n:
            take = min(n, sizes[sequence] - offset)
            placed.append((piece, begin, take, sequence, offset))
            begin, n, offset = begin + take, n - take, offset + take
            if offset == sizes[sequence]:
                sequence, offset = sequence + 1, 0
    return placed


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 1,
    quadratic: float = 1 / 2048,
    buffer_tokens: int = 1 << 20,
    by_word: bool = True,
    keep_words: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers. ``start``
    counts the document's ids before the piece and ``doc_tokens`` all its ids with ``end_id``.
    A null or empty text is one piece holding ``end_id`` alone; a null doc_id stays null. Rows
    that repeat are packed each. No rows give no rows; other columns are not looked at.
    ``keep_words`` lets a worker's next tasks use what it knows, for more memory between them.
    The tokenizer file is read on the driver and broadcast; vocabularies are a few MB.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    # A sequence id has the partition above bit 40 and the sequence within it below.

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids = (_kept if keep_words else WordIds)(tokenizer.value, by_word)
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        tokens = made = 0
        step = max(1, buffer_tokens // 2)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            ranges_of_rows = slices(sizes, step)
            for first, last in slices(sizes, max(1, LOOKED_UP // step) * step):
                # Taken, not sliced: casts of slices keep offsets that later steps misread.
                flat, counts = word_ids(texts.take(pa.array(np.arange(first, last))))
                flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                begins = starts_of(counts).tolist()
                counts = counts.tolist()
                # Ranges of so many steps end where ranges of one step do.
                for low, high in ranges_of_rows:
                    if not first <= low < last:
                        continue
                    for row in range(low, high):
                        begin, n = begins[row - first], counts[row - first]
                        for start in range(0, n, capacity):
                            stop = min(start + capacity, n)
                            held.append((doc_ids[row], start, flat[begin + start : begin + stop], n))
                        tokens += n
                    if tokens >= buffer_tokens:
                        placed, left = place([len(h[2]) for h in held], capacity, quadratic)
                        yield _rows(held, placed, base + made)
                        made += tokens // capacity
                        held = [(held[i][0], held[i][1] + a, held[i][2][a : a + n].copy(), held[i][3])
                                for i, a, n in left]
                        tokens = sum(len(h[2]) for h in held)
        placed, left = place([len(h[2]) for h in held], capacity, quadratic)
        full = tokens // capacity
        placed += [(i, a, n, full + s, o) for i, a, n, s, o in powers_of_two(left)]
        if placed:
            yield _rows(held, placed, base + made)
        if not keep_words:
            word_ids.forget()
        held.clear()
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        pack, SCHEMA
    )


def _loaded(tokenizer_json: str):
    """This worker's tokenizer. It hangs on ``sys``, which outlives the task in a worker process."""
    from tokenizers import Tokenizer

    store = sys.__dict__.setdefault("_hostvigil_tokenizers", {})
    if tokenizer_json not in store:
        store.clear()
        store[tokenizer_json] = Tokenizer.from_str(tokenizer_json)
        store[tokenizer_json].encode_special_tokens = True
    return store[tokenizer_json]


def _kept(tokenizer_json: str, by_word: bool) -> WordIds:
    """What this worker knows from earlier tasks; on ``sys`` as well."""
    store = sys.__dict__.setdefault("_hostvigil_word_ids", {})
    key = (hash(tokenizer_json), by_word)
    if key not in store:
        store.clear()
        store[key] = WordIds(tokenizer_json, by_word)
    return store[key]


def _rows(held: list[tuple], placed: list[tuple], base: int) -> pa.RecordBatch:
    columns = [
        pa.array([held[i][0] for i, *_ in placed], pa.int64()),
        pa.array([held[i][1] + a for i, a, *_ in placed], pa.int64()),
        pa.array([n for _, _, n, _, _ in placed], pa.int64()),
        pa.array([held[i][3] for i, *_ in placed], pa.int64()),
        pa.array([base + s for *_, s, _ in placed], pa.int64()),
        pa.array([o for *_, o in placed], pa.int64()),
        pa.array([held[i][2][a : a + n].tobytes() for i, a, n, *_ in placed], pa.binary()),
    ]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(columns, names)
