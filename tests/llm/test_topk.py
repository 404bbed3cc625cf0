"""Exact top-k against its SQL and against all inner products, and odd vectors."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, duck
from pyspark.sql import functions as F

from feedloom.llm import topk as M

SF = "/root/testdata/sf0.001"
LONG = (-(1 << 63), (1 << 63) - 1)


def whole(vector):
    return [min(max(math.floor(64 * x), LONG[0]), LONG[1]) for x in vector]


def plain(rows, k, every):
    """Rows (query_id, rank, vec_id, score) over all pairs."""
    good = [(i, whole(v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (query, q) in enumerate(good):
        if query is None or query % every:
            continue
        scored = []
        for b, (other, c) in enumerate(good):
            if a != b:
                score = sum(x * y for x, y in zip(q, c, strict=False))
                scored.append((-min(max(score, LONG[0]), LONG[1]), other is None, other or 0, other))
        out += [(query, rank, r[3], -r[0]) for rank, r in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, k, every, kind="double"):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id bigint, embedding array<{kind}>, score string, id int")
    return sorted(map(tuple, M.top_k(frame, F.col("vec_id") % every == 0, k).collect()), key=str)


def test_embeddings_equal_the_oracle(spark):
    _, _, problem = compare(spark, duck(SF), "op12", M.top_k_of_embeddings, M.ORACLE, SF)
    assert problem is None, problem


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_pairs_with_copies_and_small_matrices(spark, monkeypatch, kind):
    monkeypatch.setattr(M, "CHUNK", 17)
    monkeypatch.setattr(M, "BLOCK", 5)
    monkeypatch.setattr(M, "BLOCKS_A_CELL", 2)
    monkeypatch.setattr(M, "CHUNKS_A_CELL", 3)
    rng = np.random.default_rng(3)
    near = rng.normal(size=(4, 32))
    rows = [(i, [float(np.float32(x)) for x in near[i % 4] + 0.3 * rng.normal(size=32)]) for i in range(240)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [rows[0], rows[20], rows[20]]
    assert found(spark, rows, 7, 10, kind) == plain(rows, 7, 10)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, -2.0]), (1, None), (2, [1.0, None]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, [-inf, 1.0]),
        (6, []), (7, [0.5]), (8, [0.5, 0.25, 7.0]), (None, [1.0, -2.0]), (None, None), (10, [1e9, 1e9]),
        (12, [1e30, -1e30]), (14, [-1e30, 1e12]), (16, [0.0, -0.0]), (0, [1.0, -2.0]), (0, [2.0, -2.0]),
    ]
    for k in (1, 3, 50):
        assert found(spark, rows, k, 2) == plain(rows, k, 2)


def test_empty_and_lonely_tables(spark):
    assert found(spark, [], 3, 1) == []
    assert found(spark, [(0, [1.0])], 3, 1) == []
    assert found(spark, [(1, [1.0]), (3, [1.0])], 3, 2) == []


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([2, 4, 16, 64]), st.integers(1, 5000))
def test_bounds_lose_no_pair(seed, width, size):
    rng = np.random.default_rng(seed)
    q = M.Side(rng.integers(-size, size, (6, width)))
    c = M.Side(rng.integers(-size, size, (40, width)))
    scores = q.whole @ c.whole.T
    least = np.sort(scores, axis=1)[:, -4].astype(float)
    rows, cols, mask = M.survivors(q, c, least)
    kept = np.zeros(scores.shape, bool)
    kept[np.ix_(rows, cols)] = mask
    assert kept[scores >= least[:, None]].all()


def test_bounds_do_prune():
    rng = np.random.default_rng(5)
    base = np.repeat(rng.integers(-40, 40, (1, 16)), 4, axis=1)
    c = M.Side(np.concatenate([base + rng.integers(-2, 3, (20, 64)), rng.integers(-40, 40, (480, 64))]))
    q = M.Side(base)
    least = np.sort(q.whole @ c.whole.T, axis=1)[:, -10].astype(float)
    assert M.survivors(q, c, least)[2].sum() < 60
