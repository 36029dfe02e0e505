"""A convolutional text classifier for toxicity, trained in numpy on shards of all labelled rows.

A word's embedding is the sum of one row from each of two hashed tables, so that two words share
an embedding only if they collide in both. Filters of widths 1, 2 and 3 slide over the words,
each filter keeps its largest response in the text, and a logistic layer turns those into a score.
The text is all that a score sees. Per language, a threshold is calibrated on labelled rows that
the filters were not fitted to, so that few clean texts lie above it.

Every labelled row outside the held-out fold takes part. Rows are dealt to shards of bounded size;
in each of a few rounds every shard goes on from the common model through all of its rows, and the
changes are averaged, a table row's over the shards that changed it. Spark adds them up as whole
numbers, so that their order does not matter; the driver gets one model a round, whose size
TABLE_BITS bounds, and sends it to every task. Scoring needs no shuffle.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvigil.llm.common import (
    flat_lists,
    pinned,
    ranges,
    release_memory,
    slices,
    starts_of,
    stored,
    text_key,
)

TABLE_BITS = 16
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
SCHEMA = "doc_id long, lang string, score double"
#: Rows and words of a shard, on average at most, and how often the shards' models are averaged.
SHARD_ROWS = 4_000
SHARD_WORDS = 2_000_000
ROUNDS = 3
#: Changes are added up in multiples of this.
UNIT = 2.0**-36


def word_buckets(text: Column) -> Column:
    """A hash of every lower-cased run of letters or digits, in order; null has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


@dataclass
class Model:
    """Embedding tables, filters, output layer and thresholds."""

    tables: np.ndarray  # 2, rows, dims
    filters: list[np.ndarray]  # per width: width, dims, filters
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def rows_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each hash in the two tables."""
    mask = (1 << TABLE_BITS) - 1
    return hashes & mask, (hashes >> TABLE_BITS) & mask


def padded(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of words in a line where PAD blanks follow each text; text starts; window starts."""
    sizes = lengths + PAD
    begins = starts_of(sizes)
    words = ranges(begins, lengths)
    windows = np.zeros(int(sizes.sum()), bool)
    windows[ranges(begins, np.maximum(lengths, 1))] = True
    return words, begins, windows


def embed(model: Model, hashes: np.ndarray, lengths: np.ndarray):
    """Embeddings with blanks between the texts."""
    words, begins, windows = padded(hashes, lengths)
    x = np.zeros((len(windows), model.tables.shape[2]), np.float32)
    first, second = rows_of(hashes)
    x[words] = model.tables[0][first] + model.tables[1][second]
    return x, words, begins, windows


def products(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """``x @ kernel``, every row added up in the same order whatever rows lie beside it.

    A score must not depend on the batch its text came in; matrix products round by their shape.
    """
    columns = np.ascontiguousarray(x.T)
    out = np.empty((kernel.shape[1], len(x)), np.float32)
    for total, weights in zip(out, kernel.T, strict=True):
        np.multiply(columns[0], weights[0], out=total)
        for column, weight in zip(columns[1:], weights[1:], strict=True):
            total += column * weight
    return out.T


def responses(model: Model, x: np.ndarray, windows: np.ndarray, k: int) -> np.ndarray:
    """Responses of the filters of one width at every place; minus infinity where none starts."""
    width = len(model.filters[k])
    out = np.full((len(x), model.filters[k].shape[2]), -np.inf, np.float32)
    top = len(x) - width + 1
    total = products(x[:top], model.filters[k][0])
    for j in range(1, width):
        total += products(x[j : top + j], model.filters[k][j])
    out[:top] = total + model.biases[k]
    out[~windows] = -np.inf
    return out


def pooled(model: Model, x: np.ndarray, begins: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The largest response of each filter in each text."""
    return np.concatenate([
        np.maximum.reduceat(responses(model, x, windows, k), begins, axis=0)
        for k in range(len(model.filters))
    ], axis=1)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(model: Model, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A score for each text, taken in slices of about 200,000 words."""
    parts = [np.zeros(0)]
    upto = np.concatenate([[0], np.cumsum(lengths)])
    for low, high in slices(lengths, 200_000):
        x, _, begins, windows = embed(model, hashes[upto[low] : upto[high]], lengths[low:high])
        z = np.maximum(pooled(model, x, begins, windows), 0)
        parts.append(logistic(products(z, model.out[:, None])[:, 0] + model.out_bias))
    return np.concatenate(parts).astype(np.float64)


def log_odds(hot: np.ndarray, cold: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """Per table row, how much likelier texts of label 1 are to hold it; where embeddings start.

    ``hot`` and ``cold`` count the texts of either label that hold a row, of ``ones`` and ``zeros``.
    """
    ones, zeros = max(1, ones), max(1, zeros)
    p, q = (hot + 0.1) / (ones + 2), (cold + 0.1 * zeros / ones) / (zeros + 2)
    sure = (hot + cold) / (hot + cold + 3)
    return (np.clip(np.log(p / q), -3, 3) * sure / 3).astype(np.float32)


def new_model(
    odds: np.ndarray, ones: int, zeros: int, dims: int = 8, filters: int = 6, seed: int = 7
) -> Model:
    """The model that training begins with, from the tables' log odds."""
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.02, (2, 1 << TABLE_BITS, dims)).astype(np.float32)
    tables[:, :, 0] = odds
    model = Model(
        tables,
        [rng.normal(0, 0.2, (w, dims, filters)).astype(np.float32) for w in WIDTHS],
        [np.zeros(filters, np.float32) for _ in WIDTHS],
        np.full(filters * len(WIDTHS), 0.3, np.float32),
        -1.0,
    )
    for kernel in model.filters:
        kernel[:, 0, :] += 0.5 / len(kernel)
    if not ones or not zeros:  # nothing to tell apart
        model.out[:] = 0
        model.out_bias = 4.0 if ones else -4.0
    return model


def descend(
    model: Model, hashes: np.ndarray, lengths: np.ndarray, labels: np.ndarray,
    batches: list[np.ndarray], rate: float,
) -> np.ndarray:
    """Change a model by Adagrad on some batches of texts; returns which table rows changed."""
    begins = starts_of(lengths)
    dims, filters = model.filters[0].shape[1:]
    sums: dict = {}

    def step(name, value, gradient):
        sums[name] = sums.get(name, 0) + gradient * gradient
        value -= rate * gradient / (np.sqrt(sums[name]) + 1e-6)

    seen = np.zeros(model.tables.shape, np.float32)
    for chosen in batches:
        y = labels[chosen]
        h, n = hashes[ranges(begins[chosen], lengths[chosen])], lengths[chosen]
        x, words, at, windows = embed(model, h, n)
        first, second = rows_of(h)
        place = np.full((2, len(x)), -1, np.int64)
        place[0][words], place[1][words] = first, second
        pools, tops = [], []
        ends = np.append(at[1:], len(x))
        for k in range(len(WIDTHS)):
            r = responses(model, x, windows, k)
            top = np.stack([a + r[a:b].argmax(0) for a, b in zip(at, ends, strict=True)])
            tops.append(top)
            pools.append(np.take_along_axis(r, top, 0))
        z = np.concatenate(pools, axis=1)
        a = np.maximum(z, 0)
        error = (logistic(products(a, model.out[:, None])[:, 0] + model.out_bias) - y) / len(y)
        g = (error[:, None] * model.out) * (z > 0)
        step("out", model.out, a.T @ error + 1e-4 * model.out)
        bias = np.array(model.out_bias)
        step("bias", bias, error.sum())
        model.out_bias = float(bias)
        rows, gradients = [[], []], []
        for k, width in enumerate(WIDTHS):
            gk = g[:, k * filters : (k + 1) * filters]
            gradient = np.zeros_like(model.filters[k])
            for j in range(width):
                spots = tops[k] + j  # text, filter
                gradient[j] = np.einsum("nfd,nf->df", x[spots], gk)
                dx = gk[:, :, None] * model.filters[k][j].T[None]
                for t in (0, 1):
                    rows[t].append(place[t][spots].ravel())
                gradients.append(dx.reshape(-1, dims))
            step(f"b{k}", model.biases[k], gk.sum(0))
            step(f"f{k}", model.filters[k], gradient)
        dx = np.concatenate(gradients)
        for t in (0, 1):
            row = np.concatenate(rows[t])
            real = row >= 0
            different, back = np.unique(row[real], return_inverse=True)
            total = np.zeros((len(different), dims), np.float32)
            np.add.at(total, back, dx[real])
            seen[t][different] += total * total
            model.tables[t][different] -= rate * total / (np.sqrt(seen[t][different]) + 1e-6)
    return seen.any(axis=2)


def settle(model: Model, ones: int, zeros: int) -> None:
    """Batches held both labels equally; half-way back to how often they occur."""
    model.out_bias += float(np.clip(np.log(ones / zeros), -3, 3)) / 2


def fit(
    hashes: np.ndarray,
    lengths: np.ndarray,
    labels: np.ndarray,
    dims: int = 8,
    filters: int = 6,
    steps: int = 300,
    batch: int = 48,
    rate: float = 0.03,
    seed: int = 7,
) -> Model:
    """Train on texts at hand, by minibatches with as many texts of either label."""
    counts = np.zeros((2, 2, 1 << TABLE_BITS))
    for begin, n, y in zip(starts_of(lengths).tolist(), lengths.tolist(), labels.tolist(),
                           strict=True):
        for t in (0, 1):
            counts[int(y), t, np.unique(rows_of(hashes[begin : begin + n])[t])] += 1
    ones, zeros = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    odds = log_odds(counts[1], counts[0], len(ones), len(zeros))
    model = new_model(odds, len(ones), len(zeros), dims, filters, seed)
    if len(ones) and len(zeros):
        rng = np.random.default_rng([seed, 1])
        descend(model, hashes, lengths, labels, [
            np.concatenate([rng.choice(ones, batch // 2), rng.choice(zeros, batch // 2)])
            for _ in range(steps)
        ], rate)
        settle(model, len(ones), len(zeros))
    return model


def all_batches(
    labels: np.ndarray, rng: np.random.Generator, batch: int = 48, least: int = 100
) -> list[np.ndarray]:
    """Batches that hold every row, those of the rarer label again and again."""
    groups = [x for x in (np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)) if len(x)]
    each = batch // len(groups)
    steps = max(least, *(-(-len(x) // each) for x in groups))
    dealt = [np.resize(rng.permutation(x), (steps, each)) for x in groups]
    return list(np.concatenate(dealt, axis=1))


def weights_of(model: Model) -> np.ndarray:
    """All of a model but its tables, in rows as long as an embedding."""
    flat = np.concatenate([
        *(kernel.ravel() for kernel in model.filters), *model.biases, model.out, [model.out_bias],
    ]).astype(np.float64)
    dims = model.tables.shape[2]
    return np.pad(flat, (0, -len(flat) % dims)).reshape(-1, dims)


def add_weights(model: Model, change: np.ndarray) -> None:
    """Add what lies as in :func:`weights_of`."""
    flat, at = change.ravel(), 0
    for part in (*model.filters, *model.biases, model.out):
        part += flat[at : at + part.size].reshape(part.shape).astype(np.float32)
        at += part.size
    model.out_bias += float(flat[at])


def averaged(
    dealt: DataFrame, model: Model, turn: int, ones: int, zeros: int, shards: int
) -> Model:
    """The model after one round over all rows of ``dealt``."""
    dims, rows = model.tables.shape[2], 1 << TABLE_BITS
    sent = dealt.sparkSession.sparkContext.broadcast(vars(model))

    def go_on(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        # Always in the same order, also where rows share an id.
        part = part.sort_by([("doc_id", "ascending"), ("key", "ascending"), ("lang", "ascending")])
        hashes, lengths = flat_lists(part["words"])
        labels = part["toxic"].to_numpy().astype(np.float64)
        old = Model(**sent.value)
        new = copy.deepcopy(old)
        batches = all_batches(labels, np.random.default_rng([turn, key[0].as_py()]))
        changed = descend(new, hashes, lengths, labels, batches, 0.03 / (turn + 1))
        # Either label weighs the same in all, wherever the rarer one lies.
        share = (labels.sum() / ones + (1 - labels).sum() / zeros) * shards / 2
        places = np.flatnonzero(changed.ravel())
        change = np.concatenate([
            (new.tables.astype(np.float64) - old.tables).reshape(-1, dims)[places],
            weights_of(new) - weights_of(old),
        ])
        places = np.append(places, 2 * rows + np.arange(len(change) - len(places)))
        sums = np.rint(change * share / UNIT).astype(np.int64)
        out = pa.table({
            "place": places.astype(np.int32),
            "weight": np.full(len(places), round(share / UNIT), np.int64),
            **{f"d{i}": sums[:, i] for i in range(dims)},
        })
        release_memory()
        return out

    names = [f"d{i}" for i in range(dims)]
    got = (
        dealt.groupBy("shard")
        .applyInArrow(go_on, "place int, weight long, " + ", ".join(f"{d} long" for d in names))
        .groupBy("place").agg(*(F.sum(name).alias(name) for name in ("weight", *names)))
        .toArrow().sort_by("place")
    )
    place = got["place"].to_numpy()
    mean = np.stack([got[d].to_numpy() for d in names], axis=1) / got["weight"].to_numpy()[:, None]
    out, in_tables = copy.deepcopy(model), place < 2 * rows
    out.tables.reshape(-1, dims)[place[in_tables]] += mean[in_tables].astype(np.float32)
    add_weights(out, mean[~in_tables])
    return out


def calibrate(
    model: Model, found: DataFrame, most_wrong: float = 0.01, least: int = 50
) -> None:
    """Per language, the least threshold of 0.5 or more above which few clean texts lie.

    ``found`` holds lang and score of all clean calibration texts. A language with fewer than
    ``least`` of them takes the threshold of all. Scores are rounded up to four digits, so that a
    quantile is found among a bounded number of values.
    """
    above = F.percentile(F.ceil(F.greatest("score", F.lit(0.5)) * 10_000) / 10_000, 1 - most_wrong)
    sums = [F.count(F.lit(1)).alias("n"), above.alias("above")]
    lang = F.coalesce("lang", F.lit("")).alias("lang")
    whole = found.agg(*sums).first()
    model.threshold = float(whole.above) if whole.n else 0.5
    several = found.groupBy(lang).agg(*sums).filter(F.col("n") >= least)
    model.thresholds.update({row.lang: float(row.above) for row in several.orderBy("lang").collect()})


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids count as 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(1))


def holders(rows: DataFrame) -> np.ndarray:
    """How many texts of label 1 and of label 0 hold each row of the two tables."""
    mask = (1 << TABLE_BITS) - 1
    places = F.concat(
        F.transform("words", lambda h: h.bitwiseAND(mask)),
        F.transform("words", lambda h: F.shiftright(h, TABLE_BITS).bitwiseAND(mask) + mask + 1),
    )
    held = (
        rows.select("toxic", F.explode(F.array_distinct(places)).alias("place"))
        .groupBy("place").agg(F.count_if(F.col("toxic") == 1).alias("hot"),
                              F.count_if(F.col("toxic") == 0).alias("cold"))
        .toArrow()
    )  # a row per table row at most
    counts = np.zeros((2, 2 << TABLE_BITS))
    counts[:, held["place"].to_numpy()] = held["hot"].to_numpy(), held["cold"].to_numpy()
    return counts.reshape(2, 2, 1 << TABLE_BITS)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit to all labelled rows outside folds 0 and 1; all of fold 1 calibrates the thresholds.

    Labels that are null or that contradict each other for one id are left out.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter(F.col("toxic") == F.col("most")).drop("most")
    )
    # The tables' rows are told by the low half of a hash.
    low = F.transform(word_buckets(F.col("text")),
                      lambda h: F.shiftright(F.shiftleft(h, 32), 32).cast("int"))
    # Rows meet by a shuffle, as there may be any number of labels; words are shorter than texts.
    doc_id = F.col("doc_id").cast("long")
    texts = docs.filter(fold(doc_id) != 0).select(
        doc_id.alias("doc_id"), F.col("lang").cast("string"), text_key(F.col("text")).alias("key"),
        low.alias("words"))
    rows = stored(
        texts.join(known.hint("merge"), "doc_id").withColumn("fold", fold(F.col("doc_id"))))
    fitted = rows.filter("fold != 1")
    n, ones, words = fitted.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)),
        F.coalesce(F.sum(F.size("words")), F.lit(0)),
    ).first()
    zeros = n - ones
    odds = np.zeros((2, 1 << TABLE_BITS), np.float32)
    if ones and zeros:
        shards = max(-(-n // SHARD_ROWS), -(-words // SHARD_WORDS))
        shard = F.pmod(F.xxhash64("doc_id", "key", F.lit(17)), F.lit(shards)).cast("int")
        dealt = pinned(
            fitted.select(shard.alias("shard"), "doc_id", "key", "lang", "toxic", "words")
            .repartition(shards, "shard")
        )
        hot, cold = holders(dealt)
        odds = log_odds(hot, cold, ones, zeros)
    model = new_model(odds, ones, zeros)
    if ones and zeros:
        for turn in range(ROUNDS):
            model = averaged(dealt, model, turn, ones, zeros, shards)
        settle(model, ones, zeros)
    clean = rows.filter("fold = 1 and toxic = 0").select("doc_id", "lang", "words")
    calibrate(model, scored(clean, model))
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang and score of rows (doc_id, lang, words)."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))  # TABLE_BITS bounds it

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        for batch in batches:
            hashes, lengths = flat_lists(batch.column(2))
            found = scores(model, hashes, lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                ["doc_id", "lang", "score"],
            )

    return rows.mapInArrow(score, SCHEMA)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, score from 0 to 1, threshold, toxic.

    ``toxic`` says that the score reaches the language's threshold. Null and empty texts get the
    score of a text without words. Null ids and languages stay null, rows that repeat are scored
    each, and other columns are not looked at.
    """
    found = scored(docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"),
        word_buckets(F.col("text")).alias("words"),
    ), model)
    threshold = F.lit(model.threshold)
    for lang, value in model.thresholds.items():
        threshold = F.when(F.coalesce(F.col("lang"), F.lit("")) == lang, value).otherwise(threshold)
    return found.withColumn("threshold", threshold).withColumn(
        "toxic", F.col("score") >= F.col("threshold")
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    # A column function, so that texts stay in the JVM and only words and languages are sent.
    @F.arrow_udf("boolean")
    def clean(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = Model(**sent.value)
        for langs, words in batches:
            found = scores(model, *flat_lists(words))
            most = [model.thresholds.get(x or "", model.threshold) for x in langs.to_pylist()]
            yield pa.array(found < np.array(most), pa.bool_())
        release_memory()

    return docs.filter(clean(F.col("lang").cast("string"), word_buckets(F.col("text"))))
