"""The wide metrics CSV: seven comma-separated fields per line, no quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostvigil.functions import is_finite, is_number_text
from hostvigil.schemas import WIDE

# What begins a header line, and the blanks trimmed off the start of a line.
HEADER_PREFIX = "ts"
LINE_BLANKS = " \t\r\n\f\x0b"

_METRICS = WIDE.names[2:]
# Metrics are read as text, so that a refused line can be given back as it was.
_WITH_RAW = T.StructType([T.StructField(name, T.StringType()) for name in (*WIDE.names, "raw")])


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Fields as text; ``raw`` holds lines with another number of them."""
    # Headers may stand anywhere, or nowhere. All columns are parsed whichever are used: a line's
    # field count goes unchecked if some are pruned.
    reader = spark.read.schema(_WITH_RAW).options(
        header=False,
        quote="",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="raw",
        columnPruning=False,
    )
    return reader.csv(path)


def _time() -> Column:
    return F.ltrim(F.col("ts"), F.lit(LINE_BLANKS))


def _is_record() -> Column:
    """Not a header; blank lines never leave the scan."""
    return ~F.coalesce(_time().startswith(HEADER_PREFIX), F.lit(False))


def _check(rows: DataFrame) -> DataFrame:
    """Add ``problem``, complete ``raw`` for rows that have one, and null what is not finite."""
    # Cast in a step of its own: both the check and the value use it, and it runs once.
    cast = rows.withColumns(
        {f"{name}_value": F.trim(F.col(name)).try_cast("double") for name in _METRICS}
    )
    all_numbers = F.lit(True)
    for name in _METRICS:
        # The cast reads nearly all; the pattern knows further spellings of not-a-number.
        is_number = F.col(f"{name}_value").isNotNull() | is_number_text(F.col(name))
        all_numbers &= F.coalesce(is_number, F.lit(False))
    problem = F.when(F.col("raw").isNotNull(), "field_count").when(~all_numbers, "not_a_number")
    line = F.concat_ws(",", *(F.coalesce(name, F.lit("")) for name in WIDE.names))
    marked = cast.withColumn("problem", problem)
    values = (F.col(f"{name}_value") for name in _METRICS)
    return marked.select(
        _time().alias("ts"),
        "server_id",
        *(F.when(is_finite(v), v).alias(name) for name, v in zip(_METRICS, values, strict=True)),
        "problem",
        F.when(F.col("problem").isNotNull(), F.coalesce("raw", line)).alias("raw"),
    )


def fail_on_problem(checked: DataFrame) -> DataFrame:
    """Strict reading: the first bad line ends the query."""
    stop = F.raise_error(F.concat(F.col("problem"), F.lit(": "), F.col("raw")))
    # In a filter, as a column could be pruned.
    return checked.filter(
        F.when(F.col("problem").isNotNull(), stop.cast("boolean")).otherwise(True)
    )


def _without_first_records(rows: DataFrame) -> DataFrame:
    """The rows without the first record of every file.

    A row's place is its file, the block of the file that its task read, and its number among the
    task's rows, which grows along a block. Both uses of ``rows`` scan the same files in the same
    splits, so places agree. Only one place per file is joined, from a scan of its own.
    """
    block = F.col("_metadata.file_block_start")
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("file"), block.alias("block"),
        F.monotonically_increasing_id().alias("number"),
    )
    first = (
        placed.filter(_is_record())
        .groupBy(F.col("file").alias("first_file"))
        .agg(F.min(F.struct("block", "number")).alias("first"))
    )
    # Joined by the whole place, not by the file alone: a large file is no hot key then.
    same = (
        (F.col("file") == F.col("first_file"))
        & (F.col("block") == F.col("first.block"))
        & (F.col("number") == F.col("first.number"))
    )
    return placed.join(first, same, "left_anti").drop("file", "block", "number")


def read_wide_csv(
    spark: SparkSession, path: str, skip_first_record: bool = False, strict: bool = False
) -> DataFrame:
    """Read wide CSV files into wide columns plus ``problem`` and ``raw``.

    Blank lines and lines beginning like a header are skipped wherever they stand. Lines with a
    wrong number of fields or with text for a number get a ``problem`` (an error if ``strict``).
    Not-a-number and infinities are accepted and become null. ``skip_first_record`` drops the
    first record line of every file, after any header; the files are scanned twice for it.
    """
    rows = _scan(spark, path)
    if skip_first_record:
        rows = _without_first_records(rows)
    checked = _check(rows.filter(_is_record()))
    return fail_on_problem(checked) if strict else checked
