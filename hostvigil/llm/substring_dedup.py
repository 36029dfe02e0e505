"""Removal of passages that occur earlier in the corpus, by suffix automata of reference shards.

A window is ``span`` consecutive words. Every window covered by an earlier equal one is found and
its words are removed; the first occurrence stays.

An automaton for a whole corpus fits nowhere, and streaming every document past every shard would
cost the square of the corpus. So shards are cut by content: of the k-grams in a window the one
with the least hash is its anchor, equal windows have equal anchors, and consecutive windows with
the same anchor form a run. First, anchors are counted over all documents; runs whose anchor is
unique cannot repeat and are done. The other runs are dealt to shards by their anchor. In a shard,
the different runs are the reference: a suffix automaton over their words is built, earliest
first, and the runs are streamed through it (runs of an anchor that all have the same words need
none, they can only be equal). A matching statistic of ``span`` or more means that
the window ending there occurs in the reference, and the automaton's first end position says where
first. The number of shards follows the number of such runs, so shards are of bounded size.

A shard's memory is bounded by ``hot``: runs of an anchor that more runs share are not put in one. Their different
contents are cut into windows and each window goes by its own hash, with the least start taken
before and after the shuffle; the anchor and the window hash together make 128 bits. So a passage
that a third of all documents share costs a row per run and no group of that size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import (
    flat_lists,
    pinned,
    ranges,
    release_memory,
    slices,
    starts_of,
    stored,
    text_key,
    word_hashes,
)
from hostvigil.llm.order_minhash import MULTIPLIER, mixed

#: Words in a k-gram.
KGRAM = 6
#: Words in the runs of a shard, on average.
SHARD_WORDS = 40_000
SPANS = "doc_id long, key long, start int, length int"


def runs_of(hashes: np.ndarray, lengths: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: document, anchor hash, first window, windows."""
    empty = np.zeros(0, np.int64)
    windows = np.maximum(lengths - span + 1, 0)
    if not windows.sum():
        return empty, empty, empty, empty
    word = mixed(hashes.view(np.uint64))
    n = len(word) - KGRAM + 1
    grams = np.zeros(n, np.uint64)
    for j in range(KGRAM):
        grams = mixed(grams * MULTIPLIER + word[j : j + n])
    # Leftmost place of the least hash in each window's k-grams, by doubling the width covered.
    inside = span - KGRAM + 1
    least, place, width = grams.copy(), np.arange(n), 1
    while width < inside:
        step = min(width, inside - width)
        later, there = least[step:], place[step:]
        better = later < least[:-step]
        least = np.where(better, later, least[:-step])
        place = np.where(better, there, place[:-step])
        width += step
    at = ranges(starts_of(lengths), windows)
    owner = np.repeat(np.arange(len(lengths)), windows)
    chosen = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(at)))
    docs = owner[begins]
    return (docs, grams[chosen[begins]].view(np.int64), at[begins] - starts_of(lengths)[docs],
            counts)


def anchors(docs: DataFrame, span: int) -> DataFrame:
    """(doc_id, key, anchors): the anchor of every run of each document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lengths = flat_lists(batch.column(2))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for low, high in slices(lengths, 200_000):
                doc, anchor, _, _ = runs_of(hashes[upto[low] : upto[high]], lengths[low:high], span)
                found.append(anchor)
                counts.append(np.bincount(doc, minlength=high - low))
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], ["doc_id", "key", "anchors"]
            )
        release_memory()

    return docs.select("doc_id", "key", word_hashes(F.col("text")).alias("words")).mapInArrow(
        find, "doc_id long, key long, anchors array<long>"
    )


def units(docs: DataFrame, span: int) -> DataFrame:
    """The runs of documents (doc_id, key, text, wanted, hot) whose anchor is in ``wanted``.

    Columns: doc_id, key, anchor, is_hot, start, windows, content, text, the words one space apart.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = (batch.column(i).to_pylist() for i in range(3))
            hashes, lengths = flat_lists(batch.column(3))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            wanted, counts = flat_lists(batch.column(4))
            is_hot, _ = flat_lists(batch.column(5))
            ends = np.concatenate([[0], np.cumsum(counts)])
            for low, high in slices(lengths, 200_000):
                doc, anchor, start, windows = runs_of(
                    hashes[upto[low] : upto[high]], lengths[low:high], span)
                out: list[list] = [[] for _ in range(7)]
                bounds = np.searchsorted(doc, np.arange(high - low + 1))
                for i in range(low, high):
                    own = slice(bounds[i - low], bounds[i - low + 1])
                    mine = wanted[ends[i] : ends[i + 1]]
                    order = np.argsort(mine)
                    at = np.searchsorted(mine[order], anchor[own]).clip(max=len(mine) - 1)
                    place = order[at]
                    hit = np.flatnonzero(mine[place] == anchor[own])
                    words = texts[i].encode().split()
                    starts, sizes = start[own][hit], windows[own][hit] + span - 1
                    out[0] += [ids[i]] * len(hit)
                    out[1] += [keys[i]] * len(hit)
                    out[2] += anchor[own][hit].tolist()
                    out[3] += (is_hot[ends[i] : ends[i + 1]][place[hit]] > 0).tolist()
                    out[4] += starts.tolist()
                    out[5] += windows[own][hit].tolist()
                    out[6] += [b" ".join(words[a : a + n])
                               for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.bool_()),
                     pa.array(out[4], pa.int32()), pa.array(out[5], pa.int32()),
                     pa.array(out[6], pa.binary()).cast(pa.string())],
                    ["doc_id", "key", "anchor", "is_hot", "start", "windows", "text"],
                )
        release_memory()

    return docs.select(
        "doc_id", "key", "text", word_hashes(F.col("text")), "wanted", "hot"
    ).mapInArrow(
        cut, "doc_id long, key long, anchor long, is_hot boolean, start int, windows int, "
        "text string"
    )


class SuffixAutomaton:
    """The suffix automaton of some sequences of numbers, each put in one after another.

    A state's first transition lies in two lists, further ones in a dict, as almost all states
    have one. ``first`` is the end of a state's first occurrence among all the numbers put in.
    """

    def __init__(self) -> None:
        self.link, self.size, self.first = [-1], [0], [-1]
        self.symbol, self.to, self.more = [-1], [-1], {}
        self.root: dict[int, int] = {}
        self.count = 0

    def step(self, state: int, symbol: int) -> int:
        """Where a symbol leads, -1 if nowhere."""
        if state == 0:
            return self.root.get(symbol, -1)
        if self.symbol[state] == symbol:
            return self.to[state]
        more = self.more.get(state)
        return more.get(symbol, -1) if more else -1

    def put(self, state: int, symbol: int, to: int) -> None:
        if state == 0:
            self.root[symbol] = to
        elif self.symbol[state] in (-1, symbol):
            self.symbol[state], self.to[state] = symbol, to
        else:
            self.more.setdefault(state, {})[symbol] = to

    def split(self, state: int, symbol: int, below: int) -> int:
        """A state for the longest string of ``state`` plus ``symbol``, cut out of ``below``."""
        clone = len(self.size)
        self.size.append(self.size[state] + 1)
        self.link.append(self.link[below])
        self.first.append(self.first[below])
        self.symbol.append(self.symbol[below])
        self.to.append(self.to[below])
        if below in self.more:
            self.more[clone] = dict(self.more[below])
        self.link[below] = clone
        while state != -1 and self.step(state, symbol) == below:
            self.put(state, symbol, clone)
            state = self.link[state]
        return clone

    def add(self, sequence: list[int]) -> None:
        """Put one sequence in, after all those before."""
        last = 0
        for symbol in sequence:
            end, self.count = self.count, self.count + 1
            there = self.step(last, symbol)
            if there != -1:  # an earlier sequence has it
                if self.size[there] != self.size[last] + 1:
                    there = self.split(last, symbol, there)
                last = there
                continue
            new = len(self.size)
            self.size.append(self.size[last] + 1)
            self.link.append(0)
            self.first.append(end)
            self.symbol.append(-1)
            self.to.append(-1)
            state = last
            while state != -1 and (there := self.step(state, symbol)) == -1:
                self.put(state, symbol, new)
                state = self.link[state]
            if state != -1:
                if self.size[there] != self.size[state] + 1:
                    there = self.split(state, symbol, there)
                self.link[new] = there
            last = new

    def first_ends(self, sequence: list[int], span: int) -> list[int]:
        """For every window of ``span`` symbols the end of its first occurrence, -1 if none."""
        state = matched = 0
        out = []
        for at, symbol in enumerate(sequence):
            there = self.step(state, symbol)
            while there == -1 and state:
                state = self.link[state]
                matched = self.size[state]
                there = self.step(state, symbol)
            if there == -1:
                matched = 0
            else:
                state, matched = there, matched + 1
            # The statistic is cut to the window, and the state to the one that holds it.
            while self.size[self.link[state]] >= span and state:
                state = self.link[state]
            matched = min(matched, max(span, 0)) if state else matched
            if at >= span - 1:
                out.append(self.first[state] if matched >= span else -1)
        return out


def match_shard(rows: pd.DataFrame, span: int) -> pd.DataFrame:
    """Spans of words of a shard's runs that are covered by windows with an earlier start."""
    rows = rows.sort_values(["doc_id", "key", "start"], kind="stable", ignore_index=True)
    content = pd.factorize(rows["text"])[0]
    heads = np.flatnonzero(~pd.Series(content).duplicated().to_numpy())  # in order of content
    anchor = rows["anchor"].to_numpy()
    # An anchor with one content needs no automaton: its windows are first where that is first.
    several = pd.Series(anchor[heads]).duplicated(keep=False).to_numpy()
    alone = ~several[content]
    ids, keys, starts = (rows[c].to_numpy() for c in ("doc_id", "key", "start"))
    first = heads[content]
    later = alone & ((ids != ids[first]) | (keys != keys[first]) | (starts != starts[first]))
    plain = rows.loc[later, ["doc_id", "key", "start"]].assign(
        length=rows.loc[later, "windows"] + span - 1)
    codes: dict[str, int] = {}
    automaton, begins, sequences = SuffixAutomaton(), [], {}
    shared = np.flatnonzero(several).tolist()
    for c in shared:
        text = rows["text"].iat[heads[c]]
        sequences[c] = [codes.setdefault(w, len(codes)) for w in text.split(" ")]
        begins.append(automaton.count)
        automaton.add(sequences[c])
    ends_at, owners = np.array(begins), heads[shared] if shared else heads[:0]
    earliest: dict[int, list[tuple]] = {}  # (first window, windows, where the first of them was)
    for c, sequence in sequences.items():
        ends = np.array(automaton.first_ends(sequence, span)) - span + 1
        owner = np.searchsorted(ends_at, ends, side="right") - 1
        cuts = np.flatnonzero((np.diff(ends) != 1) | (np.diff(owner) != 0)) + 1
        found = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)], strict=True):
            head = owners[owner[a]]
            found.append((a, b - a, (int(ids[head]), int(keys[head]),
                                     int(starts[head] + ends[a] - ends_at[owner[a]]))))
        earliest[c] = found
    out = []
    rest = np.flatnonzero(~alone)
    for c, doc_id, key, start in zip(content[rest].tolist(), ids[rest].tolist(),
                                     keys[rest].tolist(), starts[rest].tolist(), strict=True):
        for at, windows, where in earliest[c]:
            if where < (doc_id, key, start + at):
                out.append((doc_id, key, start + at, windows + span - 1))
    out = pd.DataFrame(out, columns=["doc_id", "key", "start", "length"])
    return pd.concat([plain, out]).astype(
        {"doc_id": "int64", "key": "int64", "start": "int32", "length": "int32"}
    )


def match_hot(hot: DataFrame, span: int) -> DataFrame:
    """The same for runs of anchors that very many runs share."""
    first = F.min(F.struct("doc_id", "key", "start")).alias("first")
    contents = pinned(
        hot.withColumn("content", F.xxhash64("text")).groupBy("anchor", "content").agg(
            first, F.first("text").alias("text"))
    )
    tokens = F.split("text", " ", -1)
    each = contents.select(
        "anchor", "content", "first",
        F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size(tokens) - span + 1),
            lambda i: F.xxhash64(F.array_join(F.slice(tokens, i, F.lit(span)), " ")),
        )).alias("at", "window"),
    ).withColumn("here", F.struct(
        F.col("first.doc_id"), F.col("first.key"), (F.col("first.start") + F.col("at"))
        .alias("start")))
    least = each.groupBy("anchor", "window").agg(F.min("here").alias("where"))
    found = each.join(least, ["anchor", "window"]).groupBy("anchor", "content").agg(
        F.collect_list(F.struct("at", "where")).alias("windows")
    )
    own = F.struct("doc_id", "key", (F.col("start") + F.col("w.at")).alias("start"))
    return (
        hot.withColumn("content", F.xxhash64("text")).drop("text")
        .join(found, ["anchor", "content"])
        .select("doc_id", "key", "start", F.filter("windows", lambda w: w["where"] < F.struct(
            F.col("doc_id"), F.col("key"), (F.col("start") + w["at"]).alias("start")
        )).alias("gone"))
        .filter(F.size("gone") > 0)
        .select("doc_id", "key", F.explode("gone").alias("w"), "start")
        .select("doc_id", "key", own.getField("start").cast("int").alias("start"),
                F.lit(span).alias("length"))
    )


def remove_repeats(docs: DataFrame, span: int = 20, hot: int = 32768) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, removed, text.

    ``removed`` lists (start, length) of the words taken out, merged and in order; ``text`` is what
    is left, one space between words. Earlier means a smaller doc_id, or an earlier start in the
    same document. Rows that repeat are one document and get the same row each; rows that share a
    doc_id but not the text are different documents, ordered by a hash of the text. Rows whose
    doc_id is null keep all their words and are no reference. Null and empty texts have no words.
    No rows give no rows; other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", text_key(F.col("text")))
    of_docs = anchors(rows.filter("doc_id is not null"), span)
    each = of_docs.select("doc_id", "key", F.explode("anchors").alias("anchor"))
    repeated = pinned(
        each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    runs = repeated.agg(F.sum(F.when(F.col("n") <= hot, F.col("n")))).first()[0] or 0
    shards = max(1, -(-runs * (span + span // 2) // SHARD_WORDS))
    wanted = each.join(repeated, "anchor").groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("anchor", (F.col("n") > hot).cast("long").alias("hot")))
        .alias("found")
    ).select("doc_id", "key", F.col("found.anchor").alias("wanted"), F.col("found.hot").alias("hot"))
    cut = stored(units(rows.dropna(subset=["doc_id"]).join(wanted, ["doc_id", "key"]), span))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    cold = (
        cut.filter("not is_hot").withColumn("shard", shard)
        .select("shard", "anchor", "doc_id", "key", "start", "windows", "text")
        .groupBy("shard").applyInPandas(lambda part: match_shard(part, span), SPANS)
    )
    warm = match_hot(cut.filter("is_hot").select("anchor", "doc_id", "key", "start", "text"), span)
    spans = cold.unionByName(warm).groupBy(
        F.col("doc_id").alias("of_id"), F.col("key").alias("of_key")
    ).agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    joined = rows.join(
        spans, (F.col("doc_id") == F.col("of_id")) & (F.col("key") == F.col("of_key")), "left"
    )

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                   strict=True):
                words = text.encode().split()
                counts.append(len(words))
                merged: list[list[int]] = []
                for start, length in sorted((s["start"], s["length"]) for s in found or ()):
                    if merged and start <= sum(merged[-1]):
                        merged[-1][1] = max(merged[-1][1], start + length - merged[-1][0])
                    else:
                        merged.append([start, length])
                removed.append([{"start": a, "length": n} for a, n in merged])
                at, kept = 0, []
                for start, length in merged:
                    kept += words[at:start]
                    at = start + length
                texts.append(b" ".join(kept + words[at:]))
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, span_type),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "removed", "text"],
            )
        release_memory()

    return joined.select("doc_id", "text", "spans").mapInArrow(
        strip, "doc_id long, n_words long, removed array<struct<start:int,length:int>>, text string"
    )
