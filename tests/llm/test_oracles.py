"""Operators' queries against their SQL, and the classifier's forward pass against a plain one."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from check_oracles import compare, connect  # noqa: E402

from hostvigil.llm import toxicity  # noqa: E402
from hostvigil.llm.oracles import ORACLES  # noqa: E402
from hostvigil.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    assert name in QUERIES
    assert compare(spark, connect(FOLDER), FOLDER, name) == ""


def plain_score(model, hashes):
    """Embedding, convolution, pooling and output of one text, loop by loop."""
    first, second = toxicity.rows_of(hashes)
    x = [model.tables[0][a].astype(float) + model.tables[1][b] for a, b in
         zip(first, second, strict=True)]
    pools = []
    for kernel, bias in zip(model.filters, model.biases, strict=True):
        width, dims, filters = kernel.shape
        for f in range(filters):
            found = []
            for start in range(max(1, len(x))):
                total = float(bias[f])
                for j in range(width):  # blanks follow the text
                    if start + j < len(x):
                        total += sum(float(x[start + j][d]) * float(kernel[j, d, f])
                                     for d in range(dims))
                found.append(total)
            pools.append(max(max(found), 0.0))
    z = sum(p * float(w) for p, w in zip(pools, model.out, strict=True)) + model.out_bias
    return 1 / (1 + math.exp(-max(min(z, 30), -30)))


def test_the_forward_pass_equals_loops():
    rng = np.random.default_rng(4)
    lengths = np.array([0, 1, 2, 3, 7, 0, 12, 5])
    hashes = rng.integers(-(2**63), 2**63 - 1, int(lengths.sum()))
    labels = np.array([1, 0, 1, 0, 1, 0, 0, 1])
    model = toxicity.fit(hashes, lengths, labels, steps=15)
    for kernel in model.filters:
        kernel += rng.normal(0, 0.5, kernel.shape).astype(np.float32)
    model.out += rng.normal(0, 0.5, model.out.shape).astype(np.float32)
    got = toxicity.scores(model, hashes, lengths)
    at = 0
    for n, score in zip(lengths.tolist(), got.tolist(), strict=True):
        assert math.isclose(score, plain_score(model, hashes[at : at + n]), abs_tol=1e-5)
        at += n
