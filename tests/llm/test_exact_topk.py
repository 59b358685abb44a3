"""Exact search against brute force in Python's integers, and defined edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from contrail.llm import exact_topk as E

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, k=5, every=50):
    """Lists of (query_id, rank, vec_id, score), sorted."""
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and ok(v)]
    out = []
    for q, a in good:
        if q % every == 0:
            found = sorted((-max(E.ABSENT + 1, min(E.NO_ID, sum(x * y for x, y in zip(a, b)))), i)
                           for i, b in good if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def ours(spark, rows, k=5):
    vectors = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in E.exact_top_k(vectors.where("vec_id % 50 = 0"), vectors, k).collect())


def test_random_vectors_with_ties_and_bad_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1.0, 0.0, 0.25, 0.5)) for _ in range(3)], "x") for i in range(400)]
    rows += [(i, [1.0, 1.0, 1.0], "x") for i in range(1000, 1200)]           # a hot vector
    rows += [(50, [0.5, 0.5, 0.5], "again"), (51, [0.5, 0.5, 0.5], "again"), (51, [0.5, 0.5, 0.5], "again")]
    rows += [(2000, None, "x"), (2050, [1.0, None, 1.0], "x"), (2100, [1.0, float("nan"), 1.0], "x"),
             (2150, [float("inf")] * 3, "x"), (None, [1.0] * 3, "x"), (2200, [1e306] * 3, "x"),
             (2250, [], "x"), (2251, [], "x"), (2300, [1.0, 2.0], "x"), (2301, [-1.0, 2.0], "x"), (2350, [7.0], "x")]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, 1000) == brute(rows, 1000)
    assert ours(spark, []) == [] and ours(spark, rows[1:2]) == []


@pytest.mark.parametrize("size", [0.3, 3e3, 3e6, 3e9, 1e200])
def test_scores_are_exact_at_every_size(spark, size):
    rng = random.Random(int(size))
    rows = [(i, [size * rng.uniform(-1, 1) for _ in range(5)], "x") for i in range(150)]
    assert ours(spark, rows) == brute(rows)


def test_many_small_matrices(spark, monkeypatch):
    """Several tiles, shards, chunks and tree levels."""
    monkeypatch.setattr(E, "MATRIX_BYTES", 8 * 4 * 7)
    monkeypatch.setattr(E, "CHUNK", 3)
    monkeypatch.setattr(E, "FAN_IN", 3)
    rng = random.Random(1)
    rows = [(i, [rng.choice((0.0, 0.5, 1.0)) for _ in range(4)], "x") for i in range(700)]
    assert ours(spark, rows) == brute(rows)


def test_chunks_keep_ties_with_small_ids(monkeypatch):
    monkeypatch.setattr(E, "CHUNK", 4)
    rng = np.random.default_rng(2)
    matrix = rng.integers(-2, 3, (60, 3)).astype(float)
    ids = rng.permutation(60)
    lists = E.Lists(10, 6)
    tile = E.packed(3, 0, 0, np.arange(10) * 6, matrix[np.argsort(ids)][::6])
    for part in np.array_split(np.arange(60), 5):
        E.search(tile, E.packed(3, 0, 0, ids[part], matrix[part]), lists)
    by_id = matrix[np.argsort(ids)]
    for row, q in enumerate(range(0, 60, 6)):
        want = sorted((-int(by_id[q] @ by_id[i]), i) for i in range(60) if i != q)[:6]
        assert [(-s, i) for s, i in zip(lists.scores[row].tolist(), lists.ids[row].tolist())] == want


def test_float_lists_and_extra_columns(spark):
    rows = [(i, [float(i % 7), 1.5], "x") for i in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<float>, dim string").withColumnRenamed("dim", "bucket")
    got = E.exact_top_k(vectors.where("vec_id % 50 = 0"), vectors)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
