import math
import random

import numpy as np
import pytest

from clicklake.llm import block_search as b
from tests.llm.helpers import as_rows

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vector int"


def brute(rows, asked, k=5):
    sound = []
    for key, vector in rows:
        if key is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            sound.append((key, [math.floor(256 * x) for x in vector]))
    out = []
    for q, left in sound:
        if asked(q):
            scores = [(-sum(x * y for x, y in zip(left, v)), c) for c, v in sound if c != q and len(v) == len(left)]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, rows, asked="id % 50 = 0"):
    frame = b.integer_vectors(spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA), "vec_id", "embedding")
    return as_rows(b.top_k(frame, frame.where(asked)))


def test_ties_nulls_and_odd_vectors(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(300)]
    rows[10], rows[11], rows[12] = (10, None), (11, [None, 1.0, 1.0, 1.0]), (12, [float("nan"), 1.0, 1.0, 1.0])
    rows[13], rows[14], rows[15] = (13, [float("-inf"), 9.0, 9.0, 9.0]), (14, []), (15, [1.0])
    rows[50], rows[100] = (50, [0.1, float("inf"), 0.0, 0.0]), (100, [0.0] * 4)
    rows += [(None, [9.0] * 4), (-50, [-1.0, -1.0, 0.001, -0.001])]
    assert found(spark, rows) == brute(rows, lambda q: q % 50 == 0)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0]), (1, [2.0]), (50, [3.0]), (100, [4.0, 5.0]), (150, [])]
    assert found(spark, rows) == brute(rows, lambda q: q % 50 == 0)
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0])]) == []


def test_repeated_ids_are_candidates_of_their_own(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (1, [1.0])]
    assert found(spark, rows) == [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 1, 65536)]


def test_repeated_queries_have_lists_of_their_own(spark):
    rows = [(50, [1.0]), (50, [3.0]), (1, [2.0]), (2, [2.0]), (50, [3.0]), (100, [-1.0])]
    units = [(i, round(256 * v[0])) for i, v in rows]
    expected = []
    for at, (query, value) in enumerate(units):
        if query % 50 == 0:
            others = sorted((-value * v, i) for place, (i, v) in enumerate(units) if place != at)
            expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(others[:5], 1)]
    assert sorted(found(spark, rows)) == sorted(expected) and len(expected) == 20


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**20)) - i / 7]) for i in range(60)]
    assert found(spark, rows) == brute(rows, lambda q: q % 50 == 0)


def test_queries_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(b, "QUERY_BLOCK", 3)
    monkeypatch.setattr(b, "PILOT", 4)
    draw = random.Random(6)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    assert found(spark, rows, "id % 10 = 0") == brute(rows, lambda q: q % 10 == 0)


@pytest.mark.parametrize("block", [1, 16, 1000])
def test_blocks_are_pruned_without_a_loss(block):
    draw = np.random.default_rng(0)
    centres = draw.normal(0, 200, (40, 16))
    rows = np.floor(np.repeat(centres, 50, axis=0) + draw.normal(0, 10, (2000, 16))).astype(np.int64)
    ids = draw.permutation(2000)
    queries, names = rows[::97], ids[::97]
    top = b.TopK(len(queries), 5)
    two = lambda x: np.column_stack([x, np.zeros(len(x), np.int64)])
    computed = b.search(two(names), queries, two(ids), rows, top, block)
    scores = queries @ rows.T
    for i, name in enumerate(names):
        expected = sorted((-s, c) for s, c in zip(scores[i].tolist(), ids.tolist()) if c != name)[:5]
        assert list(zip((-top.scores[i]).tolist(), top.ids[i].tolist())) == expected
    if block < 1000:
        assert computed < 0.5 * len(queries) * len(rows)


def test_bounds_hold():
    draw = np.random.default_rng(1)
    rows, queries = draw.integers(-99, 99, (64, 5)), draw.integers(-99, 99, (7, 5))
    least, most = rows.min(axis=0, keepdims=True), rows.max(axis=0, keepdims=True)
    assert (b.bounds(queries, least, most)[:, 0] >= (queries @ rows.T).max(axis=1)).all()
