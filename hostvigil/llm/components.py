"""Connected components of a link table, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import pinned


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link; component is the least id that links reach.

    ``links`` has columns a and b, no nulls; direction, repeats and loops do not matter. Each round
    takes the least component among an id's neighbours, then that component's own component, so
    chains shrink by a factor per round. Minima combine before the shuffle, so a hub costs a row
    per task. Every round is checkpointed; nothing but the number of changes reaches the driver.
    """
    # Both directions from one evaluation: links that came out otherwise in a second one would
    # leave edges without their reverse, and ids without a component.
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    ends = F.explode(F.array(F.struct("a", "b"), back))
    both = pinned(links.filter("a <> b").select(ends.alias("ends")).select("ends.*").distinct())
    at = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.col("a")).alias("component")
    )
    at = pinned(at)
    while True:
        near = (
            both.join(at.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        )
        lower = at.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = pinned(
            lower.join(jump, "component", "left").select(
                "id", "old", F.least("component", F.coalesce("further", "component"))
                .alias("component")
            )
        )
        changed = after.filter("component <> old").limit(1).count()
        at = after.select("id", "component")
        if not changed:
            return at
