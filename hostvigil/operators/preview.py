"""First rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows, in the given order if there is one."""
    return (df.orderBy(*order) if order else df).limit(n)
