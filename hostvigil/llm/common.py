"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of every word, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def text_key(text: Column) -> Column:
    """Tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``whole``, so that no other name can clash with theirs."""
    return F.struct(*(F.col(f"`{name.replace('`', '``')}`") for name in df.columns)).alias("whole")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    A session without that setting gets one beside its warehouse, unless that is a local disk and
    the executors are elsewhere.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.sparkContext.master
        alone = master.startswith("local") and not master.startswith("local-cluster")
        if not alone and urlsplit(warehouse).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = warehouse.rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def pinned(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same in columns and compressed, which takes less of the shared folder.

    Groups of rows are small, as every task of an executor holds one before it is written.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give memory that a finished task freed back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def flat_lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after another, and the length of each list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each of some consecutive runs begins."""
    return np.cumsum(lengths) - lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0]+1, ...`` for the first length, then the next, in one array."""
    return np.repeat(starts - starts_of(lengths), lengths) + np.arange(int(lengths.sum()))


def slices(lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of runs that hold about ``most`` values each; a longer run is alone in its range."""
    if not len(lengths):
        return []
    part = (np.cumsum(lengths) - 1) // most
    edges = np.flatnonzero(np.diff(part, prepend=part[0])).tolist()
    return list(zip([0, *edges], [*edges, len(lengths)], strict=True))
