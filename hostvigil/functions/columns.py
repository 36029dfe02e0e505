"""Scalar expressions: parsing, rounding, formatting, labelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hostvigil.config import AlertRule

# The time-of-day format, the texts it reads, and what counts as a number in the wide CSV.
CLOCK_FORMAT = "HH:mm:ss"
CLOCK_PATTERN = r"\A([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"
NUMBER_PATTERN = (
    r"(?i)\A\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*\z"
)


def time_of_day(ts: Column) -> Column:
    """``HH:mm:ss`` text as a timestamp on 1970-01-01; null for anything else."""
    return F.try_to_timestamp(ts, F.lit(CLOCK_FORMAT))


def second_of_day(ts: Column) -> Column:
    """Seconds since midnight of the texts :func:`time_of_day` reads; null for anything else.

    Several times cheaper than parsing by format, and free of time zones.
    """
    hours, minutes, seconds = (F.substring(ts, at, 2).try_cast("long") for at in (1, 4, 7))
    return F.when(ts.rlike(CLOCK_PATTERN), hours * 3600 + minutes * 60 + seconds)


def clock_of(timestamp: Column) -> Column:
    """A timestamp's time of day as ``HH:mm:ss`` text."""
    return F.date_format(timestamp, CLOCK_FORMAT)


def day_second(timestamp: Column) -> Column:
    """Whole seconds since midnight by a timestamp's wall clock."""
    return F.hour(timestamp) * 3600 + F.minute(timestamp) * 60 + F.second(timestamp)


def is_number_text(text: Column) -> Column:
    """Whether a CSV field reads as a number (not-a-number and infinities included)."""
    return text.rlike(NUMBER_PATTERN)


def is_finite(value: Column) -> Column:
    """Whether a number is neither not-a-number nor infinite; null for null."""
    # NaN sorts above every number, so one comparison finds NaN and both infinities.
    return F.abs(value) < F.lit(float("inf"))


def finite_number(text: Column, kind: str = "double") -> Column:
    """Text as a number; null where it is no number or not finite."""
    value = F.trim(text).try_cast(kind)
    return F.when(is_finite(value), value)


def round_half_up(value: Column, places: int = 2) -> Column:
    """Decimal rounding with ties away from zero."""
    return F.round(value, places)


def alert_label(left: Column, right: Column, rule: AlertRule) -> Column:
    """The alert text of a window from its two (already rounded) aggregates.

    Only strictly exceeding a threshold counts, and a missing aggregate silences the window.
    """
    left_high = left > F.lit(rule.left.threshold)
    right_high = right > F.lit(rule.right.threshold)
    if_left_high = F.when(right_high, rule.both_label).otherwise(rule.left_label)
    if_left_low = F.when(right_high, rule.right_label).otherwise("")
    return F.when(left.isNull() | right.isNull(), "").otherwise(
        F.when(left_high, if_left_high).otherwise(if_left_low)
    )
