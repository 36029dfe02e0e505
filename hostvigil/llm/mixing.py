"""Mixing sources to target weights by hierarchical budgets.

A tree of domain, language and source carries weights. The token budget of the whole is split down
the tree: children share their parent's budget by weight, none above what its leaves can give
(all their tokens, ``epochs`` times), and what a child cannot take goes to its siblings by weight.
Only when a whole subtree runs short does its parent's sibling gain. Each leaf then takes its
documents in a seeded order of its own per epoch: whole epochs first, then the longest prefix of
the next epoch's order that fits the rest of its budget.

Budgets are computed in integers by windows over children with the same parent, one row per child.
The prefix is found without sorting a leaf in one place: a document's seeded hash puts it in one of
the leaf's buckets, whose token sums are accumulated; only the bucket in which the budget ends is
sorted. A leaf has about one bucket per ``BUCKET_DOCS`` documents, so neither the buckets of a leaf
nor the documents of a bucket are a number near that of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostvigil.llm.common import pinned, whole_row, words

BUCKET_DOCS = 4096
LEVELS = ("domain", "lang", "source")


def shared_out(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """``nodes`` (weight, capacity) with the budget each gets of its parent's ``budget``.

    Children that cannot take their share are filled; sorted by capacity per weight they come
    first. The rest share what is left by weight, in whole tokens rounded down.
    """
    order = [(F.col("capacity") * F.lit(1.0) / F.col("weight")), F.col("capacity"), F.col("name")]
    before = Window.partitionBy(*parent).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parent)
    wide = "decimal(38,0)"
    out = (
        nodes.withColumn("of_parent", budget.cast(wide))
        .withColumn("filled", F.sum(F.col("capacity").cast(wide)).over(before))
        .withColumn("after", F.sum("weight").over(whole) - F.sum("weight").over(before))
    )
    # Full if this child and all before it can be filled at the price per weight it asks.
    full = (
        F.col("filled").cast(wide) * F.col("weight")
        + F.col("capacity").cast(wide) * F.col("after")
        <= F.col("of_parent") * F.col("weight")
    )
    out = out.withColumn("full", full)
    left = F.col("of_parent") - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("capacity").cast(wide))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(whole)
    out = out.withColumn("left", left.cast(wide)).withColumn("open", open_weight)
    share = F.expr("cast(left * weight div open as bigint)")
    return out.withColumn(
        "budget", F.when(F.col("full"), F.col("capacity")).otherwise(
            F.least(share, F.col("capacity")))
    ).drop("of_parent", "filled", "after", "full", "left", "open")


def weighted(nodes: DataFrame, weights: dict[str, int], level: str) -> DataFrame:
    """``nodes`` with a ``weight``: that of the name, or 1; weight 0 or less leaves a node out."""
    value = F.lit(1).cast("long")
    for name, weight in weights.items():
        value = F.when(F.col(level) == name, F.lit(weight).cast("long")).otherwise(value)
    return nodes.withColumn("weight", value).withColumn("name", F.col(level)).filter("weight > 0")


def leaf_budgets(
    leaves: DataFrame, weights: dict[str, dict[str, int]], total: Column | int, epochs: int
) -> DataFrame:
    """(domain, lang, source, tokens, docs, budget) of leaves (domain, lang, source, tokens, docs)."""
    keys = list(LEVELS)
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    # A node whose parent is left out is out as well.
    for level in LEVELS:
        leaves = weighted(leaves, weights.get(level, {}), level).drop("weight", "name")
    budgets = None
    for depth in range(1, len(keys) + 1):
        nodes = leaves.groupBy(*keys[:depth]).agg(F.sum("capacity").alias("capacity"))
        nodes = weighted(nodes, weights.get(keys[depth - 1], {}), keys[depth - 1])
        if budgets is None:
            whole = leaves.agg(F.least(F.sum("capacity"), F.lit(total)).alias("given"))
            nodes = nodes.withColumn("one", F.lit(1)).join(
                F.broadcast(whole.withColumn("one", F.lit(1))), "one")  # one row
            parent = ["one"]
        else:
            nodes = nodes.join(budgets.withColumnRenamed("budget", "given"), keys[: depth - 1])
            parent = keys[: depth - 1]
        budgets = shared_out(nodes, parent, F.col("given")).select(*keys[:depth], "budget")
    return leaves.join(budgets, keys).select(*keys, "tokens", "docs", "budget")


def seeded(seed: int, epoch: Column) -> Column:
    """A document's place in the order of an epoch, from 0 to 2**62."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("long"), "doc_id", "row"), 2)


def mix(
    docs: DataFrame,
    domain: Column,
    weights: dict[str, dict[str, int]] | None = None,
    share: float | None = None,
    total: int | None = None,
    epochs: int = 2,
    seed: int = 5,
    tokens: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs`` that is in a leaf: how often the mixture takes it.

    Columns: doc_id, row, domain, lang, source, n_tokens, copies, leaf_budget. ``weights`` gives
    integer weights per level and name, 1 where it names none. The budget is ``total`` tokens, or
    ``share`` (0.75) of all tokens. ``row`` is a hash of the text. Null domains, languages and
    sources are written as an empty name. A text without tokens costs nothing and is taken as often
    as the prefix reaches its place; an epoch of which no token is taken is not begun. Rows with the same doc_id and text have one place in the
    order and are taken together. A null doc_id is an id like any other. No rows give no rows;
    other columns are not looked at.
    """
    weights = weights or {}
    n_tokens = F.size(words(F.col("text"))) if tokens is None else tokens
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = pinned(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row"),
        name(domain).alias("domain"), name(F.col("lang")).alias("lang"),
        name(F.col("source")).alias("source"), n_tokens.cast("long").alias("n_tokens"),
    ))
    keys = list(LEVELS)
    leaves = rows.groupBy(*keys).agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    if total is None:
        all_tokens = rows.agg(F.sum("n_tokens")).first()[0] or 0
        total = int(all_tokens * (0.75 if share is None else share))
    budgets = pinned(leaf_budgets(leaves, weights, total, epochs))
    # Whole epochs, then tokens of the next one.
    plan = budgets.withColumn("whole", F.expr("if(tokens > 0, budget div tokens, 0)")).withColumn(
        "rest", F.col("budget") - F.col("whole") * F.col("tokens")
    ).withColumn("buckets", F.ceil(F.col("docs") / BUCKET_DOCS).cast("long"))
    placed = rows.join(plan.select(*keys, "whole", "rest", "buckets", "budget"), keys).withColumn(
        "place", seeded(seed, F.col("whole"))
    ).withColumn("bucket", F.floor(F.col("place") / F.lit(2.0 ** 62) * F.col("buckets")))
    sums = placed.groupBy(*keys, "bucket").agg(
        F.sum("n_tokens").alias("in_bucket"), F.first("rest").alias("rest"))
    # Buckets of a leaf, a few thousandths of its documents.
    run = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(run), F.lit(0)))
    whole_bucket = F.col("before") + F.col("in_bucket") <= F.col("rest")
    cut = F.col("before") <= F.col("rest")
    placed = placed.join(
        starts.select(*keys, "bucket", "before", F.when(whole_bucket, "in").when(cut, "cut")
                      .otherwise("out").alias("state")), [*keys, "bucket"])
    inside = Window.partitionBy(*keys, "bucket").orderBy(
        F.struct("place", "doc_id", "row")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = placed.filter("state = 'cut'").withColumn(
        "fits", F.col("before") + F.sum("n_tokens").over(inside) <= F.col("rest"))
    rest = placed.filter("state <> 'cut'").withColumn("fits", F.col("state") == "in")
    # Whole epochs that use up the budget begin no further one, not even with empty texts.
    begun = (F.col("rest") > 0) | (F.col("whole") == 0)
    return last.unionByName(rest).select(
        "doc_id", "row", *keys, "n_tokens",
        (F.col("whole") + (F.col("fits") & begun).cast("long")).alias("copies"),
        F.col("budget").alias("leaf_budget"),
    )


def mixed_documents(docs: DataFrame, mixture: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with all their columns, whatever
    their names."""
    names = mixture.select("doc_id", "row", "copies").distinct()
    row = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    wrapped = docs.select(
        whole_row(docs), F.col("doc_id").cast("long").alias("own_id"), row.alias("own_row"))
    joined = wrapped.join(
        names, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_row") == F.col("row")))
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return joined.filter("copies > 0").select("whole", F.explode(times)).select("whole.*")
