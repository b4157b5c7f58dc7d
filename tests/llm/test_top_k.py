import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from rollcall.llm import top_k

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, every=2, k=5):
    good = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i in sorted({i for i, _ in good if i % every == 0}):
        for q in {tuple(v) for j, v in good if j == i}:
            s = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), j) for j, v in good if j != i)
            out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, tile, block):
    vectors = top_k.quantized(spark.createDataFrame(rows, SCHEMA))
    found = top_k.top_k(vectors, vectors.filter("vec_id % 2 = 0"), tile=tile, block=block)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("tile,block", [(7, 5), (8192, 2048)])
def test_against_brute_force(spark, tile, block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(60)]
    rows += [(60 + i, rows[4][1]) for i in range(9)]  # ties
    rows += [(80, None), (82, [None, 1.0]), (84, [float("nan")]), (86, [float("inf")]), (None, [1.0]),
             (88, []), (90, [0.5, -0.5]), (92, rng.normal(size=70).tolist())]
    assert run(spark, rows, tile, block) == brute(rows)


def test_few_and_none(spark):
    assert run(spark, [(0, [1.0]), (2, [2.0])], 10, 10) == [(0, 1, 2, 131072), (2, 1, 0, 131072)]
    assert run(spark, [(0, [1.0])], 10, 10) == [] and run(spark, [], 10, 10) == []


def test_one_identifier_with_two_vectors(spark):
    """Two queries, each with its own ranks."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(20)]
    rows += [(4, rng.normal(size=12).tolist()), rows[6]]
    got = run(spark, rows, 7, 3)
    assert got == brute(rows)
    assert [r[1] for r in got if r[0] == 4] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [r[1] for r in got if r[0] == 6] == [1, 2, 3, 4, 5]


def test_large_numbers(spark):
    rows = [(0, [1e9, 3.0]), (1, [1e9, 4.0]), (3, [1e9 + 1, -2.0])]
    assert run(spark, rows, 10, 10) == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 60), st.integers(0, 10**6), st.integers(1, 7))
def test_search_loses_nobody(n, width, seed, k):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-40, 40, size=(n, width)).astype(np.float64)
    query = rng.integers(-40, 40, size=width).astype(np.float64)
    power = rows.T**2
    mass = [power[a:].sum(axis=0) for a in range(0, width, top_k.DIMENSIONS)] + [np.zeros(n)]
    ids = rng.permutation(n)
    found, score = top_k.search(query, -1, np.ascontiguousarray(rows.T), ids, mass, k)
    want = sorted((-(r @ query), i) for r, i in zip(rows, ids))[:k]
    assert [(-s, i) for s, i in zip(score, ids[found])] == want
