"""Top-k search against all scores."""

import numpy as np
import pytest

from footfall.llm import topk

DDL = "vec_id long, embedding array<double>, rank int, score string"


def brute_force(rows, k, scale=256):
    seen = {}
    for vec_id, vector, *_ in rows:
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            ints = tuple(int(np.floor(max(min(scale * x, 2.0**62), -(2.0**62)))) for x in vector)
            seen.setdefault((vec_id, ints))
    result = {}
    for q, v in seen:
        if q % 50 == 0:
            scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in seen if i != q and len(w) == len(v)]
            result[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: best for q, best in result.items() if best}


def search(spark, rows, k=5, **how):
    frame = spark.createDataFrame(rows, DDL)
    result = topk.exact_topk(frame, frame.filter("vec_id % 50 = 0"), k, **how)
    assert result.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    found = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r["rank"] == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("block", [8192, 60])
@pytest.mark.parametrize("steps", [4, 16])
def test_equals_all_scores(spark, monkeypatch, block, steps):
    monkeypatch.setattr(topk, "STEPS", steps)
    monkeypatch.setattr(topk, "FEW", 3)
    rng = np.random.default_rng(steps)
    centres = rng.normal(size=(6, 12))
    vectors = centres[rng.integers(0, 6, 900)] + rng.normal(size=(900, 12)) * 0.3
    vectors[300:600] = vectors[300]  # a third are copies
    vectors[700:720] = 0
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(vectors.tolist() and vectors)]
    assert search(spark, rows, block=block, queries_together=7) == brute_force(rows, 5)


def test_few_steps_read_less_than_everything(monkeypatch):
    read = []
    monkeypatch.setattr(topk.Block, "resolve", lambda self, q, query, rows, k, most: read.append(len(rows)) or [])
    rng = np.random.default_rng(3)
    vectors = (rng.exponential(size=(4000, 4)) ** 3 * 50).astype(np.int64)
    topk.Block(np.arange(4000), vectors).search(np.array([-1]), np.array([[5, 1, 0, 2]]), 5)
    assert read and read[0] <= topk.FEW  # stopped by the bounds, not at the lists' end


def test_defined_cases(spark):
    big = 1e300
    rows = [
        (0, [1.0, 2.0], 1, "s"), (50, None, 1, "s"), (100, [1.0, None], 1, "s"), (150, [float("nan"), 1.0], None, None),
        (200, [float("inf"), 1.0], 1, "s"), (1, [1.0, 2.0], 1, "s"), (1, [1.0, 2.0], 1, "s"), (None, [9.0, 9.0], 1, "s"),
        (250, [1.0, 2.0, 3.0], 1, "s"), (300, [], 1, "s"), (2, [], 1, "s"), (3, [big, -big], 1, "s"), (350, [big, big], 1, "s"),
        (4, [-0.001, 0.0], 1, "s"), (-50, [0.5, 0.5], 1, "s"), (0, [1.0, 2.0], 1, "s"), (5, [1e9, 1e9], 1, "s"),
    ]
    assert search(spark, rows) == brute_force(rows, 5)
    assert search(spark, [(1, [1.0], 1, "s")]) == {}
    assert topk.digest(spark.createDataFrame([], DDL)).count() == 0


def test_many_rows_with_one_id(spark):
    """Repeated rows are combined before they move; others of one id are dealt over the blocks."""
    rows = [(1, [float(i % 700), 1.0], 1, "s") for i in range(30_000)] + [(50, [1.0, 0.0], 1, "s"), (2, [699.0, 0.0], 1, "s")]
    frame = spark.createDataFrame(rows, DDL)
    found = topk.exact_topk(frame, frame.filter("vec_id = 50"), 3, block=64).collect()
    scale = 256 * 256
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 1, 699 * scale), (2, 2, 699 * scale), (3, 1, 698 * scale)]
