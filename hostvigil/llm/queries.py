"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.llm import (
    fill_middle,
    license_templates,
    licenses,
    mixing,
    order_minhash,
    packing,
    pii,
    quality_lines,
    secrets,
    subspace_join,
    substring_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from hostvigil.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                 s["end"].cast("string"))),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_quality_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of ``documents``; a document's source is its host."""
    return quality_lines.judge_documents(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in ``documents``; the base kinds come first among equal starts."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE))
    sure = F.filter(spans, lambda s: s["evidence"].isNotNull())
    return secrets.scan_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
        F.size(sure).cast("long").alias("n_confirmed"),
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` without windows of 20 words that start earlier elsewhere."""
    removed = F.aggregate("removed", F.lit(0), lambda n, s: n + s["length"])
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", removed.cast("long").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near duplicates in ``documents``."""
    return order_minhash.near_duplicates(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` in sequences of at most 2048 tokens."""
    # Larger buffers look words up less often; the pipeline's executors hold other stages as well.
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, TOKENIZER, buffer_tokens=1 << 21, keep_words=True).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


#: Integer weights of the mixture; names not listed weigh 1. The tables have no domain column, so
#: a document's domain is the last digit of its source's number, three domains in all.
MIX_WEIGHTS = {
    "domain": {"d0": 2, "d1": 3, "d2": 1},
    "lang": {"en": 6, "de": 2, "fr": 2, "es": 3},
    "source": {"src0": 2},
}


def source_domain() -> Column:
    digits = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "([0-9])$", 1)
    return F.concat(F.lit("d"), (F.coalesce(digits.try_cast("int"), F.lit(0)) % 3).cast("string"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often the mixture of ``documents`` takes each of them."""
    return mixing.mix(table(spark, folder, "documents"), source_domain(), MIX_WEIGHTS).drop("row")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of ``documents``, learnt from ``labels`` outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        F.col("toxic").alias("rejected"),
    )


def op8_subspace_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of ``embeddings``."""
    return subspace_join.similar_vectors(table(spark, folder, "embeddings"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in ``documents``."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE))
    return pii.find_personal_data(table(spark, folder, "documents")).select(
        "doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for every url of ``pages``."""
    return url_filter.filter_urls(table(spark, folder, "pages")).select(
        "page_id", "host", "path", "rule", "verdict",
        F.array_join("tokens", " ").alias("tokens"), "block_odds",
    )


def op11_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in ``documents``."""
    matches = F.col("matches")
    base = F.filter(matches, lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["first_word"])

    def labels(found: Column) -> Column:
        names = F.transform(found, lambda m: m["label"])
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    scanned = licenses.scan_licenses(
        table(spark, folder, "documents"), license_templates.TEMPLATES, license_templates.PHRASES
    )
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(matches).alias("labels"), "score",
    )


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizers' tokens of ``documents`` aligned."""
    return token_alignment.align_documents(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` as fill-in-the-middle texts, cut between code points."""
    output, form = F.col("output"), F.col("form")
    return fill_middle.fill_middle(table(spark, folder, "documents")).select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(output, form), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_lines": op1_quality_lines,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_order_minhash": op4_order_minhash,
    "op5_packing": op5_packing,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_subspace_join": op8_subspace_join,
    "op9_personal_data": op9_personal_data,
    "op10_url_filter": op10_url_filter,
    "op11_license_templates": op11_license_templates,
    "op12_token_alignment": op12_token_alignment,
    "op13_fill_middle": op13_fill_middle,
}
