"""A corpus pipeline of the operators; each stage reads what the one before it wrote.

Every stage but the last returns the columns of ``documents``. Decisions take effect: toxic
documents go, one document of each group of near duplicates stays, secrets are replaced in the
text, the mixture drops what is over budget, and what is left is packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvigil.llm import mixing, order_minhash, packing, secrets, toxicity
from hostvigil.llm.common import shared_folder, table
from hostvigil.llm.queries import MIX_WEIGHTS, TOKENIZER, source_domain

#: The mixture's budget, as a share of the tokens that reach it. No document is repeated.
MIX_SHARE = 0.9


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not judged toxic; the model learns from the labelled documents it is given."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates, once; rows with a null doc_id stay."""
    return order_minhash.drop_near_duplicates(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes."""
    mixture = mixing.mix(docs, source_domain(), MIX_WEIGHTS, share=MIX_SHARE, epochs=1)
    return mixing.mixed_documents(docs, mixture)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and the sequences they lie in."""
    return packing.pack_documents(docs, TOKENIZER).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
