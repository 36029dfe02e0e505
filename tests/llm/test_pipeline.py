"""The stages of the corpus pipeline on odd tables."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")

#: Names that the operators use for columns of their own.
CLASHING = (
    "_gone", "_key", "_mix_id", "whole", "id", "key", "gone", "row", "copies", "own_id", "col",
    "domain", "n_tokens", "bucket", "place", "redacted", "redacted_", "label", "score", "words",
    "spans", "class_id", "kept", "component", "a.b", "values", "n", "digest", "ids", "toxic", "fold",
)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rows():
    r = random.Random(3)
    text = lambda n: " ".join(r.choice("abcdefgh") + str(r.randint(0, 99)) for _ in range(n))
    copied, secret = text(80), "password: hunter2hunter2 " + text(60)
    texts = [None, "", " \n", "one", copied, copied, copied + " more", secret, text(3000),
             *(text(r.randint(20, 120)) for _ in range(30))]
    out = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, len(t or "") or None)
           for i, t in enumerate(texts)]
    out += [out[4], out[4], (7, copied, "de", "src1", 9), (None, secret, None, None, None),
            (None, None, None, None, None), (None, copied, "en", "src0", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    names = ", ".join(f"`{name}` string" for name in CLASHING)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {names}"
    return spark.createDataFrame([(*row, *CLASHING) for row in rows()], schema)


STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_any_columns_nulls_and_repeated_rows(spark, docs, name):
    found = STAGES[name](spark, docs, FOLDER)
    if name != "packing":
        assert found.columns == docs.columns
        assert all(tuple(r)[5:] == CLASHING for r in found.collect())
    given = Counter(tuple(r)[:5] for r in docs.collect())
    got = Counter(tuple(r)[:5] for r in found.collect())
    if name == "near_dedup":
        assert all(n == 1 for row, n in got.items() if row[0] is not None)
        assert {r for r in given if r[0] is None} <= set(got)
        assert sum(r[1] is not None and r[1].startswith(rows()[4][1]) for r in got if r[0] is not None
                   ) == 1
    if name == "secrets":
        assert sum(got.values()) == sum(given.values())
        assert not any("hunter2" in (r[1] or "") for r in got)
        assert {r for r in given if "hunter2" not in (r[1] or "")} <= set(got)
    if name == "mixing":
        assert not got - given and got
    if name == "toxicity":
        assert not got - given


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_empty_tables(spark, docs, name):
    found = STAGES[name](spark, docs.limit(0), FOLDER)
    assert found.count() == 0
    if name != "packing":
        assert found.columns == docs.columns


def test_the_pipeline_equals_its_stages(spark):
    """Every stage works on what the one before it kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {"documents": docs.count()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs.cache()
        kept[name] = docs.count()
        assert docs.columns == list(COLUMNS)
    assert kept["documents"] > kept["toxicity"] > kept["near_dedup"] == kept["secrets"] > kept["mixing"]
    want = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    pieces = lambda df: Counter(
        (r.doc_id, r.doc_tokens) for r in df.filter("start = 0").collect())
    assert pieces(corpus_pipeline.run(spark, FOLDER)) == pieces(want)
