"""Near duplicates by Order MinHash, verified by banded alignment.

Texts are compared as words in lower case. A document's k-mers (five words each) are labelled with
how often they occurred before, so that repeats count. Each of several hash functions picks the
``PICKED`` labelled k-mers with the least hashes and puts them in text order; the hash of that
sequence is one sketch. Two documents share a sketch only if they share the picked k-mers in the
same order, which makes sketches sensitive to edit similarity rather than to shared words alone.
At a similarity of 0.8 between the sets of labelled k-mers, the chance to share none of the
sketches is 8e-8, and far less for closer texts. It is larger for very short texts (4e-7 for 8 words
against 9) and for words replaced here and there, which break five k-mers each (README has figures).

Documents that share a sketch are candidates; they are linked if an alignment of their words needs
at most 0.2 edits per word of the longer one. Documents with the same words are one text
throughout. Within a bucket of candidates every text is aligned with the bucket's first text. Edit
distances obey the triangle inequality, so only two things remain: texts out of the first text's
reach are compared with one another, and texts just beyond its reach also with those at the rim
of its reach. The remainder goes through block against block comparisons inside tasks, which lose
no pair, hold two bounded blocks in memory and return links only. No bucket is cut and no list of
all pairs is made; a bucket of near copies costs as many alignments as it has texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
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
    text_key,
    whole_row,
    word_hashes,
)
from hostvigil.llm.components import connected_components

KMER = 5
PICKED = 2
SKETCHES = 16
#: In units of the most edits of similar texts: two texts further apart than this from a third
#: one and from its circle have no similar texts there. Twice, and a quarter for longer texts.
FURTHEST = 2.5
#: Texts in one block of a block against block comparison.
BLOCK = 256
#: Edits up to which a distance is sought diagonal by diagonal, before the banded table.
FEW = 24
#: Words are counted by this many hash values where a bound on the distance is enough.
BAG = 512
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix whose low and high bits both depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def occurrence_labels(owner: np.ndarray, kmers: np.ndarray) -> np.ndarray:
    """How often each k-mer stood earlier in the same document."""
    order = np.lexsort((kmers, owner))
    o, k = owner[order], kmers[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    labels = np.empty(len(k), np.int64)
    labels[order] = np.arange(len(k)) - first
    return labels


def sketches(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SKETCHES numbers for each document, from its word hashes.

    A document shorter than a k-mer has one k-mer holding all its words.
    """
    word = mixed(hashes.view(np.uint64))
    counts = np.maximum(lengths - KMER + 1, 1)
    counts[lengths == 0] = 0
    at = ranges(starts_of(lengths), counts)
    ends = np.repeat(starts_of(lengths) + lengths, counts)
    kmers = np.zeros(len(at), np.uint64)
    for j in range(KMER):
        inside = at + j < ends
        kmers = kmers * MULTIPLIER
        kmers[inside] += word[at[inside] + j]
        kmers = mixed(kmers + np.uint64(j + 1))
    owner = np.repeat(np.arange(len(lengths)), counts)
    labelled = mixed(kmers + occurrence_labels(owner, kmers).astype(np.uint64) * MULTIPLIER)
    out = np.zeros((len(lengths), SKETCHES), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out.view(np.int64)
    begins = starts_of(counts)[full]
    for s in range(SKETCHES):
        ranked = mixed(labelled ^ mixed(np.full(1, s + 1, np.uint64) * MULTIPLIER))
        picked, left = [], ranked.copy()
        for _ in range(PICKED):
            least = np.minimum.reduceat(left, begins)
            hit = np.flatnonzero(left == np.repeat(least, counts[full]))
            # One place per document; equal hashes there are equal labelled k-mers only by chance.
            docs, first = np.unique(owner[hit], return_index=True)
            place = np.full(len(lengths), -1, np.int64)
            place[docs] = hit[first]
            picked.append(place[full])
            left[hit[first]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        places = np.sort(np.stack(picked), axis=0)
        total = np.full(len(full), s + 1, np.uint64)
        for row in places:
            total = mixed(total * MULTIPLIER + labelled[row])
        out[full, s] = total
    return out.view(np.int64)


def encoded(texts: list[list[str]]) -> list[np.ndarray]:
    """Word lists as numbers that are equal where the words are."""
    codes: dict[str, int] = {}
    return [np.fromiter((codes.setdefault(w, len(codes)) for w in x), np.int64, len(x))
            for x in texts]


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edits (insert, delete, replace) between two word sequences; ``most`` + 1 if more.

    Aligned in a band around the diagonal that widens until it holds the answer.
    """
    if len(a) > len(b):
        a, b = b, a
    shorter = min(len(a), len(b))
    differ = np.flatnonzero(a[:shorter] != b[:shorter])
    head = int(differ[0]) if len(differ) else shorter
    a, b = a[head:], b[head:]
    shorter = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:shorter] != b[::-1][:shorter])
    tail = int(differ[0]) if len(differ) else shorter
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(b) - len(a) > most:
        return most + 1
    if not len(a):
        return len(b)
    if least_distance(a, b) > most:
        return most + 1
    found = few_edits(a, b, min(most, FEW))
    if found <= min(most, FEW) or most <= FEW:
        return min(found, most + 1)
    return min(whole_table(a.tolist(), b.tolist()), most + 1)


def few_edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """The edit distance if it is at most ``most``, else ``most`` + 1.

    For each number of edits, the furthest place reached on every diagonal, which then slides along
    equal words to that diagonal's next difference.
    """
    n, m = len(a), len(b)
    differences: dict[int, list[int]] = {}

    def slide(k: int, i: int) -> int:
        if k not in differences:
            low, high = max(0, -k), min(n, m - k)
            differ = np.flatnonzero(a[low:high] != b[low + k : high + k]) + low
            differences[k] = [*differ.tolist(), high]
        stops = differences[k]
        return stops[bisect_left(stops, i)]

    at = {0: slide(0, 0)}
    if m == n and at[0] >= n:
        return 0
    for edits in range(1, most + 1):
        new = {}
        for k in range(max(-edits, -n), min(edits, m) + 1):
            i = max(at.get(k, -2) + 1, at.get(k - 1, -2), at.get(k + 1, -2) + 1)
            i = min(i, n, m - k)
            if i >= max(0, -k):
                new[k] = slide(k, i)
        if new.get(m - n, -1) >= n:
            return edits
        at = new
    return most + 1


def whole_table(a: list[int], b: list[int]) -> int:
    """The edit distance from all diagonals, a row of the table at a time in the bits of integers.

    ``plus`` and ``minus`` hold where neighbouring cells of a row differ by 1 and by -1.
    """
    ones, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    equal: dict[int, int] = {}
    for i, word in enumerate(a):
        equal[word] = equal.get(word, 0) | 1 << i
    plus, minus, distance = ones, 0, len(a)
    for word in b:
        same = equal.get(word, 0)
        diagonal = (((same & plus) + plus) ^ plus) | same
        up = minus | (ones & ~(diagonal | plus))
        down = plus & diagonal
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
        up = (up << 1 | 1) & ones
        stay = same | minus
        plus = (down << 1 & ones) | (ones & ~(stay | up))
        minus = up & stay
    return distance


def limit_of(n, m, similarity: float):
    """The most edits that leave two texts of n and m words similar enough."""
    return np.floor((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)


def least_distance(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound: words of the longer text without a partner in the other."""
    top = int(max(a.max(initial=0), b.max(initial=0))) + 1
    shared = np.minimum(np.bincount(a, minlength=top), np.bincount(b, minlength=top)).sum()
    return max(len(a), len(b)) - int(shared)


def aligned(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b, distance, reach) of pairs (a, b, text_a, text_b).

    ``reach`` is the most edits of similar texts. A distance up to it is exact, as is any up to
    ``FURTHEST`` times it, unless it is a lower bound of more than one and a half times it.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, reach = [], []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = encoded([split_words(left.as_py()), split_words(right.as_py())])
                most = int(limit_of(len(x), len(y), similarity))
                distance = least_distance(x, y)
                if distance <= 1.5 * most:
                    distance = edit_distance(x, y, int(FURTHEST * most) + 1)
                reach.append(most)
                found.append(distance)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int32()),
                 pa.array(reach, pa.int32())], ["a", "b", "distance", "reach"],
            )
        release_memory()

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(
        align, "a long, b long, distance int, reach int"
    )


def split_words(text: str) -> list[bytes]:
    """The words of a text in lower case."""
    return text.lower().encode().split()


def compare_blocks(rows: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links (a, b) between components of texts, within a block or between two of a bucket.

    Texts of one component need no more links, so only others are aligned, likeliest first. Which
    links those are depends on the order of the texts, so that is fixed: a retried task finds the
    same ones again.
    """
    rows = rows.sort_values("text_id", ignore_index=True)
    codes = encoded([split_words(t) for t in rows["text"]])
    n = np.array([len(c) for c in codes])
    bags = np.stack([np.bincount(c % BAG, minlength=BAG) for c in codes]).astype(np.int32)
    names, component = np.unique(rows["component"].to_numpy(), return_inverse=True)
    block = rows["block"].to_numpy()
    part = rows["part"].map({"rest": 0, "shell": 1, "rim": 2}).to_numpy()
    cross = len(np.unique(block)) > 1
    out = []
    for i in range(1, len(codes)):
        others = slice(0, i)
        most = limit_of(n[others], n[i], similarity)
        apart = np.maximum(n[others], n[i]) - np.minimum(bags[others], bags[i]).sum(1)
        near = apart <= most
        if cross:
            near &= block[others] != block[i]
        # Those at the rim have only those of the shell left to meet.
        rim = (part[others] == 2) | (part[i] == 2)
        near &= ~rim | (part[others] + part[i] == 3)
        near = np.flatnonzero(near & (component[others] != component[i]))
        for j in near[np.argsort(apart[near] - most[near], kind="stable")].tolist():
            u, v = component[i], component[j]
            if u != v and edit_distance(codes[i], codes[j], int(most[j])) <= most[j]:
                out.append((names[u], names[v]))
                component[component == v] = u
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, key, digest, n, values): each row's words as a digest, and their sketches."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lengths = flat_lists(batch.column(2))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            parts = [np.zeros((0, SKETCHES), np.int64)]
            for low, high in slices(lengths, 100_000):
                parts.append(sketches(hashes[upto[low] : upto[high]], lengths[low:high]))
            values = pa.array(np.concatenate(parts).ravel())
            digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                       for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                 pa.array(lengths.astype(np.int32)),
                 pa.FixedSizeListArray.from_arrays(values, SKETCHES).cast(pa.list_(pa.int64()))],
                ["doc_id", "key", "digest", "n", "values"],
            )
        release_memory()

    return docs.select("doc_id", "key", word_hashes(F.lower("text"))).mapInArrow(
        sketch, "doc_id long, key long, digest binary, n int, values array<long>"
    )


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_class_rows, kept.

    ``class_id`` is the least doc_id that links reach, ``n_class_rows`` counts the rows of the class
    and ``kept`` marks the text that stands for it under that doc_id, in all its rows if they
    repeat. Rows that share a doc_id but not the text are classed by their texts, and at most one of
    those in a class is kept. Rows whose doc_id is null and texts without words are classes of
    their own and kept; class_id is then the doc_id. No rows give no rows; other columns are not
    looked at.
    """
    return classed_rows(docs, similarity).drop("key")


def classed_rows(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """What ``near_duplicates`` returns and ``key``, the ``text_key`` of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", text_key(F.col("text")))
    every = pinned(sketched(rows))
    classed = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    members = every.filter(classed)
    # Texts are numbered, since several may have one doc_id.
    texts = pinned(
        members.groupBy("digest").agg(
            F.min(F.struct("doc_id", "key")).alias("least"), F.first("n").alias("n"),
            F.first("values").alias("values"), F.count(F.lit(1)).alias("n_rows"),
        ).select("digest", F.monotonically_increasing_id().alias("text_id"), "least", "n", "values",
                 "n_rows")
    )
    components = text_components(texts, rows, similarity)
    named = texts.join(components.withColumnRenamed("id", "text_id"), "text_id", "left").select(
        "digest", F.coalesce("component", "text_id").alias("component"), "least", "n_rows"
    )
    sizes = named.groupBy("component").agg(
        F.sum("n_rows").alias("n_class_rows"), F.min("least").alias("first"))
    named = named.select("digest", "component").join(sizes, "component")
    out = members.select("doc_id", "key", "digest").join(named, "digest").select(
        "doc_id", "key", F.col("first.doc_id").alias("class_id"), "n_class_rows",
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
        .alias("kept"),
    )
    rest = every.filter(~classed).select(
        "doc_id", "key", F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("n_class_rows"), F.lit(True).alias("kept"),
    )
    return out.unionByName(rest)


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One text of each class of near duplicates, once, with all columns, whatever their names.

    Rows with a null doc_id stay.
    """
    gone = classed_rows(docs, similarity).filter(~F.col("kept") & F.col("doc_id").isNotNull())
    gone = gone.select(F.col("doc_id").alias("gone"), F.col("key").alias("gone_key")).distinct()
    wrapped = docs.select(
        whole_row(docs), F.col("doc_id").cast("long").alias("id"),
        text_key(F.col("text").cast("string")).alias("key"))
    same = (F.col("id") == F.col("gone")) & (F.col("key") == F.col("gone_key"))
    kept = wrapped.join(gone, same, "left_anti")
    once = kept.filter("id is not null").dropDuplicates(["id", "key"])
    return once.unionByName(kept.filter("id is null")).select("whole.*")


def text_components(texts: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """(id, component) of texts linked because they share a sketch and are similar enough.

    ``texts`` holds (text_id, least, n, values) and ``rows`` (doc_id, key, text); the rows with the
    doc_id and key in ``least`` hold the text.
    """
    short = texts.select("text_id", "n", F.explode(F.array_distinct("values")).alias("bucket"))
    leaders = short.groupBy("bucket").agg(
        F.min(F.struct("text_id", "n")).alias("leader"), F.count(F.lit(1)).alias("size")
    ).filter("size > 1").select("bucket", "leader.text_id", "leader.n").toDF("bucket", "a", "n_a")
    found = pinned(
        short.join(leaders, "bucket").filter("text_id <> a").select(
            "bucket", "a", "n_a", F.col("text_id").alias("b"), F.col("n").alias("n_b")
        )
    )
    pairs = found.select("a", "n_a", "b", "n_b").distinct()
    longest = F.greatest("n_a", "n_b")
    close = F.abs(F.col("n_a") - F.col("n_b")) <= FURTHEST * (1 - similarity) * longest + 1
    ids = pairs.select(F.col("a").alias("text_id")).union(pairs.select("b")).distinct()
    names = texts.select("text_id", "least.doc_id", "least.key").join(ids, "text_id")
    held = pinned(
        rows.join(names, ["doc_id", "key"]).select("text_id", "text").dropDuplicates(["text_id"])
    )
    wide = (
        pairs.filter(close).select("a", "b")
        .join(held.toDF("a", "text_a"), "a").join(held.toDF("b", "text_b"), "b")
    )
    measured = pinned(aligned(wide, similarity))
    links = measured.filter("distance <= reach").select("a", "b")
    first = connected_components(links)
    # What the first text of a bucket leaves open, where links have not settled it elsewhere.
    known = found.join(measured, ["a", "b"], "left")
    for side in ("a", "b"):
        of_side = first.toDF(side, f"component_{side}")
        known = known.join(of_side, side, "left").withColumn(
            f"component_{side}", F.coalesce(f"component_{side}", side))
    far = F.col("distance").isNull() | (F.col("distance") > F.floor(FURTHEST * F.col("reach")) + 1)
    known = known.withColumn(
        "part", F.when(F.col("distance") <= F.col("reach"), "near").when(far, "rest")
        .otherwise("shell"),
    )
    per_bucket = known.groupBy("bucket").agg(
        F.count_if(F.col("part") != "near").alias("open"),
        F.min(F.when(F.col("part") == "shell", F.col("distance"))).alias("shell_at"),
        F.max(F.greatest("n_a", "n_b")).alias("longest"),
        F.min(F.least("component_a", "component_b")).alias("lowest"),
        F.max(F.greatest("component_a", "component_b")).alias("highest"),
    ).filter("(open > 1 or shell_at is not null) and lowest <> highest")
    # A near text can only be similar to one of the shell if its own distance makes up for it.
    rim = (F.col("part") == "near") & (
        F.col("distance") >= F.col("shell_at") - (1 - similarity) * F.col("longest") - 1
    )
    opened = pinned(
        known.join(per_bucket, "bucket").filter((F.col("part") != "near") | rim).select(
            "bucket", F.col("b").alias("text_id"), F.col("component_b").alias("component"),
            F.when(F.col("part") == "near", "rim").otherwise(F.col("part")).alias("part"),
        )
    )
    blocks = opened.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = opened.join(blocks, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("text_id"), F.col("blocks")).cast("int")
    ).select(
        "bucket", "text_id", "component", "part", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    rest = (
        dealt.join(held, "text_id")
        .groupBy("bucket", F.least("block", "other").alias("i"),
                 F.greatest("block", "other").alias("j"))
        .applyInPandas(lambda rows: compare_blocks(rows, similarity), "a long, b long")
    )
    second = connected_components(rest).toDF("component", "further")
    return first.join(second, "component", "full").select(
        F.coalesce("id", "component").alias("id"), F.coalesce("further", "component")
        .alias("component"),
    )
