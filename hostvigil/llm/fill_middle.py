"""Fill-in-the-middle training texts: two cuts, and the pieces reordered around markers.

A batch's bytes are held as a wavelet matrix over byte classes. Ranks of the classes that bound a
unit (code points, or pieces up to a blank or a line end) add up to boundary counts; bisection on
them finds the byte of every cut of the batch at once, whatever the unit. Nothing is shuffled and
a text stays in one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import release_memory, slices
from hostvigil.llm.wavelet import BLANK, CONTINUATION, LEVELS, LINE, WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Classes whose bytes begin a unit, or (for the others) end one.
BEGIN = {"chars": frozenset(range(1 << LEVELS)) - {CONTINUATION}}
END = {"words": frozenset({BLANK, LINE}), "lines": frozenset({LINE})}
#: Bytes of text whose matrix is held at a time; a longer text has one of its own.
SLICE_BYTES = 1 << 22

SCHEMA = (
    "doc_id long, n long, form string, prefix_units long, middle_units long, output string"
)


def seeds(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers per document: the first hex digits of a SHA-256."""
    digest = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256
    )
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


class Cutter:
    """Boundary counts and cut positions of texts that lie one after another."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, unit: str):
        self.matrix = WaveletMatrix(data)
        self.stops = ends
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.begins = unit in BEGIN
        self.kinds = BEGIN[unit] if self.begins else END[unit]
        self.base = self.matrix.count(self.kinds, self.starts)
        self.n = self.matrix.count(self.kinds, self.stops) - self.base
        if not self.begins:  # what follows the last end is a unit as well
            last = self.locate(self.n)
            self.n = self.n + (last < self.stops)

    def locate(self, units: np.ndarray) -> np.ndarray:
        """Where each text's first so many units end."""
        # A unit ends where the next one begins, or behind the byte that ends it.
        target = self.base + units + self.begins
        at = self.matrix.locate(self.kinds, target, self.starts, self.stops)
        if self.begins:  # the byte before begins the next unit, unless the text ends
            whole = self.matrix.count(self.kinds, self.stops) < target
            at = np.where(whole, self.stops, at - 1)
        return np.where(units == 0, self.starts, at)


def fill_middle(
    docs: DataFrame, unit: str = "chars", seed: int = 1, plain_share: int = 10, spm_share: int = 20
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_units, middle_units, output.

    ``n`` counts the units. Both cuts come from the document's seeds, so a rerun cuts alike.
    ``plain_share`` percent of the documents, empty texts and texts holding a marker keep form
    ``plain`` and their text, and have no cuts. Of the others ``spm_share`` percent lead with the
    suffix. A null text counts as empty; a null doc_id is hashed as no digits; repeated rows give
    repeated results; an empty table gives none; other columns are not looked at.
    """
    if unit not in BEGIN | END:
        raise ValueError(f"unknown unit: {unit!r}")

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for low, high in slices(sizes, SLICE_BYTES):
                yield _transformed(batch.slice(low, high - low), unit, plain_share, spm_share)
        release_memory()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"),
        *(h.alias(f"h{k}") for k, h in enumerate(seeds(doc_id, seed), 1)),
    ).mapInArrow(transform, SCHEMA)


def _transformed(
    batch: pa.RecordBatch, unit: str, plain_share: int, spm_share: int
) -> pa.RecordBatch:
    texts = batch.column(1)
    raw = [x.encode() for x in texts.to_pylist()]
    ends = np.cumsum([len(x) for x in raw]).astype(np.int64)
    cutter = Cutter(np.frombuffer(b"".join(raw), np.uint8), ends, unit)
    h1, h2, h3, h4 = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6))
    cuts = h1 % (cutter.n + 1), h2 % (cutter.n + 1)
    first, last = np.minimum(*cuts), np.maximum(*cuts)
    plain = (ends == cutter.starts) | (h3 % 100 >= 100 - plain_share)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    spm = h4 % 100 < spm_share
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    output, form = [], []
    at = zip(
        raw, (cutter.locate(first) - cutter.starts).tolist(),
        (cutter.locate(last) - cutter.starts).tolist(), plain.tolist(), spm.tolist(), strict=True,
    )
    for text, a, b, is_plain, is_spm in at:
        if is_plain:
            output.append(text)
        elif is_spm:
            output.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            output.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
        form.append("plain" if is_plain else "spm" if is_spm else "psm")
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(cutter.n, pa.int64()),
            pa.array(form, pa.string()),
            pa.array(first, pa.int64(), mask=plain),
            pa.array(last - first, pa.int64(), mask=plain),
            pa.array(output, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n", "form", "prefix_units", "middle_units", "output"],
    )


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of; only the output and its form are read.

    No marker lies in the text, nor can one arise across a seam, as none begins with another's end.
    """
    second = F.when(form == "spm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX))
    cut = F.instr(output, second)
    lead = F.substring(output, F.lit(len(PREFIX) + 1), cut - len(PREFIX) - 1)
    rest = F.substring(output, cut + len(PREFIX), F.length(output))
    middle_at = F.instr(rest, F.lit(MIDDLE))
    next_ = F.substring(rest, F.lit(1), middle_at - 1)
    middle = F.substring(rest, middle_at + len(MIDDLE), F.length(rest))
    return (
        F.when(form == "psm", F.concat(lead, middle, next_))
        .when(form == "spm", F.concat(next_, middle, lead))
        .otherwise(output)
    )
