"""Collision counting against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrylane.llm import collisions


def brute(rows, k, every):
    """query id -> [(vec_id, score)]."""
    usable = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in usable:
        if i % every == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in usable if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def search(spark, rows, k=20, every=20, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({n: F.lit("x") for n in ("content", "first", "bound", "query")})
    got = {}
    for r in collisions.nearest(df.repartition(3), F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("lengths", ["unit", "mixed"])
def test_recall_against_brute_force(llm, monkeypatch, lengths):
    """Even vectors, groups of near ones, several waves of small blocks."""
    for name, value in (("BLOCK_ROWS", 1024), ("BLOCK_VALUES", 1), ("QUERY_ROWS", 40), ("WAVE", 2)):
        monkeypatch.setattr(collisions, name, value)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3500, 32))
    x[:600] = x[0] + 0.3 * rng.normal(size=(600, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "mixed":
        x *= rng.uniform(0.2, 3, size=(len(x), 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = search(llm, rows), brute(rows, 20, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.97
    scores = {q: dict(brute(rows, len(rows), 1000)[q]) for q in want if q % 1000 == 0}
    for q, all_scores in scores.items():
        assert [s for _, s in got[q]] == [all_scores[i] for i, _ in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_odd_vectors_ties_and_copies(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [2.0, -0.0]), (4, [0.0, 1.0]), (5, [-3.0, 1.0]), (6, None), (7, []),
            (8, [0.0, -0.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 3.0]), (40, [1e200, 1e200]), (60, [1e-200, 1e-200]),
            (80, [5.0]), (None, [1.0, 1.0]), (-20, [0.0, 1.0]), (100, None), (120, [0.0, 0.0])]
    got, want = search(llm, rows, k=4), brute(rows, 4, 20)
    assert {q: v for q, v in want.items() if v} == got and 80 in want and 80 not in got
    assert got[0][1:3] == [(3, 2.0), (1, 1.0)] and got[20][1:] == [(3, 2.0), (0, 1.0), (1, 1.0)]


def test_a_hot_vector_repeated_ids_and_no_rows(llm):
    rows = [(i, [1.0, 2.0]) for i in range(200)] + [(i, [1.0, 2.0 + i / 1000]) for i in range(200, 300)] + [(20, [1.0, 2.0]), (20, [9.0, 9.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collisions.nearest(df.repartition(4), F.col("vec_id") % 20 == 0, 20)
    by_query = {(r.query_id, r.vec_id) for r in got.collect()}
    assert all(q != i for q, i in by_query) and len({q for q, _ in by_query}) == 15
    lists = got.groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in lists} == {i: 40 if i == 20 else 20 for i in range(0, 300, 20)}
    assert collisions.nearest(df.limit(0), F.lit(True), 5).isEmpty()


def test_the_threshold_lets_what_lies_within_the_radius_pass():
    allowed = collisions.misses_allowed()
    rng = np.random.default_rng(2)
    misses = (np.abs(rng.normal(size=(20_000, collisions.PROJECTIONS))) > collisions.HALF_WIDTH).sum(axis=1)
    assert 0.97 <= (misses <= allowed).mean() <= 0.999
