"""Quality rules over lines: boilerplate found by how many documents of a host share a line.

Lines are normalised (lower case, a run of digits as 0, blanks as one space) and hashed. Per host,
the number of distinct documents (ids) with each hash is counted. Lines above the limits are taken
out, and a document left with too few of its words is rejected as depleted; a page that a host has
under more ids than the limits allow is boilerplate as a whole, and so are its copies.

Documents with the same text are counted once per host, so each different text sends one row per
distinct line, weighted by its documents, and counts are summed before the shuffle: a line that
every document shares costs a row per task. Only hashes are shuffled, never texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from hostvigil.llm.common import BLANKS, pinned, text_key, word_hashes, words

SYMBOLS = "#*$%&|<>"
BLANK_CHARACTERS = "\x20\x09\x0a\x0b\x0c\x0d"


def normalised(line: Column) -> Column:
    """A line in lower case, runs of digits as 0 and of blanks as one space, none at the ends."""
    spaced = F.regexp_replace(F.lower(line), BLANKS, " ")
    return F.trim(F.regexp_replace(spaced, "[0-9]+", "0"))


def worded_lines(text: Column) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.trim(
        F.translate(line, BLANK_CHARACTERS, "")) != "")


def base_metrics(text: Column) -> dict[str, Column]:
    """Counts over one text: words, their characters, symbols, repeated lines and words."""
    lines = worded_lines(text)
    return {
        "word_chars": F.length(F.translate(text, BLANK_CHARACTERS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "hashes": word_hashes(text),
    }


@F.pandas_udf(LongType())
def repeated_words(column: pd.Series) -> pd.Series:
    """Words covered by a run of three that the text has more than once, from word hashes."""
    out = []
    for found in column:
        found = np.asarray(found, np.int64).view(np.uint64)
        n = len(found)
        if n < 4:
            out.append(0)
            continue
        # Odd multipliers keep the order of the three apart; sums wrap around.
        runs = found[:-2] * np.uint64(0x9E3779B97F4A7C15) + found[1:-1]
        runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + found[2:]
        order = np.argsort(runs, kind="stable")
        same = runs[order][1:] == runs[order][:-1]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = twice.copy()
        covered[1:] |= twice[:-1]
        covered[2:] |= twice[:-2]
        out.append(int(covered.sum()))
    return pd.Series(out, dtype="int64")


def line_counts(lines: DataFrame, per_host: DataFrame, most: int, share: float) -> DataFrame:
    """(host, line) of the lines in more than ``most`` documents and ``share`` of a host's."""
    counted = lines.groupBy("host", "line").agg(F.sum("n_docs").alias("n_docs"))
    return (
        counted.filter(F.col("n_docs") > most)
        .join(per_host, counted["host"].eqNullSafe(per_host["of_host"]))
        .filter(F.col("n_docs") > share * F.col("host_docs"))
        .select("host", "line")
    )


def judge_documents(
    docs: DataFrame,
    host: str = "source",
    most_docs: int = 20,
    most_share: float = 0.002,
    least_left: float = 0.5,
    least_words: int = 50,
    most_repeated: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs`` with its metrics and verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_line_words
    (words in lines that were taken out), base_failed, kept. A line goes if more than
    ``most_docs`` distinct documents of its host and more than ``most_share`` of them hold it. A
    document is kept if it passes the base rules and at least ``least_left`` of its words stay.

    Null and empty texts have no words and fail. A null host is a host of its own. Rows that
    repeat get the same row each and count once; rows that share a doc_id but not the text are
    judged apart and count once per text, null ids too. No rows give no rows; other columns are
    not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("key", text_key(F.col("text")))
    hashed = chosen.select(
        "host", "key", "doc_id",
        F.transform(worded_lines(text), lambda line: F.struct(
            F.xxhash64(normalised(line)).alias("line"), F.size(words(line)).alias("words"),
        )).alias("lines"),
    )
    # Documents per text in two steps: the ids of a text with many copies meet nowhere.
    ids = hashed.groupBy("host", "key", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    per_text = ids.groupBy(F.col("host").alias("t_host"), F.col("key").alias("t_key")).agg(
        F.count(F.lit(1)).alias("n_docs"))
    first = hashed.groupBy("host", "key").agg(F.first("lines").alias("lines"))
    # Hashes only, kept for three uses.
    copies = pinned(
        first.join(per_text, F.col("host").eqNullSafe(F.col("t_host"))
                   & (F.col("key") == F.col("t_key"))).select("host", "key", "n_docs", "lines")
    )
    per_host = copies.groupBy(F.col("host").alias("of_host")).agg(
        F.sum("n_docs").alias("host_docs")
    )
    distinct = copies.select(
        "host", "n_docs",
        F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"),
    )
    common = line_counts(distinct, per_host, most_docs, most_share)
    # Lines to take out are looked up once per distinct text of a host.
    spread = copies.select("host", "key", F.explode("lines").alias("x")).select(
        "host", "key", F.col("x.line").alias("line"), F.col("x.words").alias("words")
    ).groupBy("host", "key", "line").agg(F.sum("words").alias("words"))
    out = (
        spread.join(common.withColumnsRenamed({"host": "c_host", "line": "c_line"}),
                    F.col("host").eqNullSafe(F.col("c_host")) & (F.col("line") == F.col("c_line")))
        .groupBy(F.col("host").alias("o_host"), F.col("key").alias("o_key"))
        .agg(F.sum("words").alias("n_line_words"))
    )
    metrics = base_metrics(text)
    measured = (
        chosen.select("doc_id", "host", "key", *(c.alias(n) for n, c in metrics.items()))
        .withColumn("n_words", F.size("hashes").cast("long"))
        .withColumn("n_repeat_words", repeated_words(F.col("hashes"))).drop("hashes")
    )
    left = F.col("n_words") - F.col("n_line_words")
    failed = (F.col("n_words") < least_words) | (
        F.col("n_repeat_words") > most_repeated * F.col("n_words")
    )
    return (
        measured.join(out, F.col("host").eqNullSafe(F.col("o_host"))
                      & (F.col("key") == F.col("o_key")), "left")
        .withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= least_left * F.col("n_words")))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "n_line_words", "base_failed", "kept")
    )
