"""Alert rules: which two metrics are paired, how they are aggregated, when they alert."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

DAY_SECONDS = 24 * 3600
_CLOCK = re.compile(r"([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]")


def clock_seconds(text: str) -> int:
    """Seconds since midnight of a zero-padded ``HH:mm:ss``."""
    if not _CLOCK.fullmatch(text):
        raise ValueError(f"not an HH:mm:ss time of day: {text!r}")
    hours, minutes, seconds = (int(part) for part in text.split(":"))
    return hours * 3600 + minutes * 60 + seconds


def clock_text(seconds: int) -> str:
    """The inverse of :func:`clock_seconds`."""
    return f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


@dataclass(frozen=True)
class Side:
    """One metric of a pair."""

    topic: str
    metric: str
    metric_type: str  # width the metric is aggregated in; floats stay floats
    output: str
    threshold: float


@dataclass(frozen=True)
class AlertRule:
    """Everything that distinguishes one alerting job from another."""

    name: str
    left: Side
    right: Side
    aggregate: str  # "avg" or "max", applied to both metrics
    both_label: str
    left_label: str
    right_label: str
    size_seconds: int = 30
    slide_seconds: int = 10
    cutoff: str | None = "20:53:00"  # earliest window start kept, by time of day

    def __post_init__(self) -> None:
        if self.aggregate not in ("avg", "max"):
            raise ValueError(f"unknown aggregate: {self.aggregate!r}")
        if not 0 < self.slide_seconds <= self.size_seconds <= DAY_SECONDS:
            raise ValueError("need 0 < slide <= size <= one day")
        if self.cutoff is not None:
            clock_seconds(self.cutoff)

    def with_thresholds(self, left: float | None = None, right: float | None = None) -> AlertRule:
        """The same rule with one or both thresholds replaced."""
        return replace(
            self,
            left=self.left if left is None else replace(self.left, threshold=float(left)),
            right=self.right if right is None else replace(self.right, threshold=float(right)),
        )

    @property
    def crossing_seconds(self) -> int:
        """How far into a day a reading can still belong to a window of the day before.

        Windows sit on multiples of the slide. If the slide divides the day, the last window of
        a day starts one slide before midnight; if not, just short of midnight at worst.
        """
        if DAY_SECONDS % self.slide_seconds == 0:
            return self.size_seconds - self.slide_seconds
        return self.size_seconds


# Metric pairs, thresholds and labels of the two standard jobs.
CPU_MEM = AlertRule(
    name="cpu_mem",
    left=Side("topic-cpu", "cpu_pct", "float", "avg_cpu", 75.69),
    right=Side("topic-mem", "mem_pct", "float", "avg_mem", 74.28),
    aggregate="avg",
    both_label="High CPU + Memory stress",
    left_label="CPU spike suspected",
    right_label="Memory saturation suspected",
)
NET_DISK = AlertRule(
    name="net_disk",
    left=Side("topic-net", "net_in", "double", "max_net_in", 6477.4),
    right=Side("topic-disk", "disk_io", "double", "max_disk_io", 1176.57),
    aggregate="max",
    both_label="Network flood + Disk thrash suspected",
    left_label="Possible DDoS",
    right_label="Disk thrash suspected",
)

# Names used in a thresholds file, and the rule and side each one sets.
THRESHOLD_NAMES = {
    "cpu_threshold": ("cpu_mem", "left"),
    "mem_threshold": ("cpu_mem", "right"),
    "net_in_threshold": ("net_disk", "left"),
    "disk_io_threshold": ("net_disk", "right"),
}


def parse_thresholds(lines: Iterable[str]) -> dict[str, AlertRule]:
    """Both standard rules, with the thresholds given as ``name: value`` lines applied."""
    rules = {rule.name: rule for rule in (CPU_MEM, NET_DISK)}
    for line in lines:
        if not line.strip():
            continue
        name, separator, value = line.partition(":")
        target = THRESHOLD_NAMES.get(name.strip())
        if not separator or target is None:
            raise ValueError(f"not a threshold line: {line!r}")
        rule, side = target
        rules[rule] = rules[rule].with_thresholds(**{side: float(value)})
    return rules


def load_thresholds(spark: SparkSession, path: str) -> dict[str, AlertRule]:
    """Read a thresholds file from any file system Spark can reach."""
    # Line by line, so that a file of something else ends at its first line.
    return parse_thresholds(row.value for row in spark.read.text(path).toLocalIterator())
