from __future__ import annotations

import math

import numpy as np

import brute
from agoralake.llm import vector_links
from agoralake.llm.vector_links import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _vectors(rng):
    rows = []
    for k in range(120):
        rows.append((k, rng.standard_normal(16), k % 3))
    for k in range(60):  # pairs about the threshold
        x = rows[k][1] + rng.standard_normal(16) * (0.12 + k / 200)
        rows.append((200 + k, x, k % 3))
    center = rng.standard_normal(16)
    rows += [(400 + k, center + rng.standard_normal(16) * 0.01, 1) for k in range(70)]  # one ball
    rows += [(600 + k, center * 2 + rng.standard_normal(16) * 0.3, 1) for k in range(60)]  # a wide group
    return [(i, [float(np.float32(v)) for v in x], l) for i, x, l in rows]


def test_equals_brute_force(spark):
    rows = _vectors(np.random.default_rng(2))
    got = {
        r.vec_id: (r.n_links, r.component_id, r.kept)
        for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    }
    want = brute.cosine_links(rows, 0.93)
    assert got == {k: (n, c, c == k) for k, (n, c) in want.items()}


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0], 5), (2, [2.0, 0.0], 5), (3, [1.0, 0.0], None), (4, [1.0, 0.0], 6), (5, None, 5),
        (6, [0.0, 0.0], 5), (7, [1.0, None], 5), (8, [1.0, nan], 5), (9, [inf, 0.0], 5), (10, [], 5),
        (11, [1.0, 0.0, 0.0], 5), (2, [2.0, 0.0], 5), (None, [1.0, 0.0], 5), (12, [3e38, 0.0], 5),
    ]
    wide = "vec_id bigint, embedding array<float>, label int, kept string"
    out = near_vectors(spark.createDataFrame([(*r, "x") for r in rows], wide))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert got.pop(None) == (0, None, False)
    assert {k: v for k, v in got.items() if k in (1, 2, 12)} == {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False)}
    assert all(v == (0, k, True) for k, v in got.items() if k not in (1, 2, 12))
    assert out.count() == 13
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def _links(spark, rows):
    found = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.vec_id: (r.n_links, r.component_id) for r in found}


def test_a_group_longer_than_all_lists_is_linked_exactly(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "ROUNDS", 2)
    monkeypatch.setattr(vector_links, "STARTS", 1)
    monkeypatch.setattr(vector_links, "BLOCK", 50, raising=False)
    rng = np.random.default_rng(5)
    center = rng.standard_normal(256)
    center /= np.linalg.norm(center)
    # All pairs at a cosine of about 0.95: linked, and no two in one ball.
    near = center + rng.standard_normal((150, 256)) * math.sqrt((1 / 0.95 - 1) / 256)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(near)]
    rows += [(1000 + k, rng.standard_normal(256).tolist(), 1) for k in range(150)]
    assert _links(spark, rows) == brute.cosine_links(rows, 0.93)


def test_groups_that_miss_the_audit_are_linked_exactly(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "ROUNDS", 0)
    monkeypatch.setattr(vector_links, "STARTS", 1)
    monkeypatch.setattr(vector_links, "ORDERS", 1)
    rows = _vectors(np.random.default_rng(2))
    assert _links(spark, rows) == brute.cosine_links(rows, 0.93)
