import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportloom.operators import vectors

T = "vec_id long, embedding array<double>"


def plain(rows, asked, k):
    """Every query against every vector of its length."""
    sound = lambda e: e is not None and None not in e and all(map(math.isfinite, e)) and any(e)
    held = [(i, np.array(e) / np.linalg.norm(e)) for i, e in rows if i is not None and sound(e)]
    out = {}
    for q, e in asked:
        if q is not None and sound(e):
            u = np.array(e) / np.linalg.norm(e)
            scored = sorted((-round(float(u @ v), 6), i) for i, v in held if len(v) == len(u))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: v for q, v in out.items() if v}


def found(spark, rows, asked, k, **more):
    got = vectors.vector_all(spark.createDataFrame(asked, T).withColumnRenamed("vec_id", "query_id"), spark.createDataFrame(rows, T), k, **more)
    out = {}
    for r in got.orderBy("query_id", F.desc("score"), "vec_id").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out, got


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-6)
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_nearest_vectors_are_those_of_a_whole_comparison(spark, monkeypatch):
    monkeypatch.setattr(vectors, "VECTORS", 40)
    monkeypatch.setattr(vectors, "QUERIES", 7)
    monkeypatch.setattr(vectors, "CENTRE_ROWS", 30)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    # a third of the rows are one vector, and lengths differ
    e = [(centres[i % 12] + 0.15 * rng.normal(size=16) if i % 3 else centres[0]).tolist() for i in range(900)]
    rows = [(i, x) for i, x in enumerate(e)] + [(900 + i, rng.normal(size=3).tolist()) for i in range(30)] + [(990, [1.0] * 5)]
    asked = [r for r in rows if r[0] % 30 == 0] + [(5001, rng.normal(size=16).tolist()), (5002, [1.0, 2.0])]
    got, frame = found(spark, rows, asked, 9, counted=True)
    same(got, plain(rows, asked, 9))
    work = {r.query_id: r.compared for r in frame.select("query_id", "compared").distinct().collect()}
    assert sum(work.values()) < 0.7 * len(work) * len(rows)


def test_odd_vectors_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 2)  # most lengths have no centre
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1e-200, 0.0]), (10, [-1e200, 0.0]), (11, [3.0]), (12, [1.0, 2.0, 3.0]), (13, [0.0] * 11_999 + [1.0])]
    asked = [(i, e) for i, e in rows if i != 8] + [(20, [0.5, 0.5]), (21, [1.0] * 12_000)]
    got, _ = found(spark, rows, asked, 3)
    assert got.pop(9) == got.pop(1) == [(1, 1.0), (8, 1.0), (8, 1.0)] and got.pop(10)[0] == (10, 1.0)
    same(got, {q: v for q, v in plain([r for r in rows if r[0] not in (9, 10)], asked, 3).items() if q in got} | {20: [(1, 0.707107), (8, 0.707107), (8, 0.707107)]})
    assert set(got) == {11, 12, 13, 20, 21}
    assert not found(spark, [], asked, 3)[0] and not found(spark, rows, [], 3)[0]
