import math

import numpy as np
from pyspark.sql import functions as F

from spanshade.llm.topk_search import Segments, scaled, top_k, usable


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi in {i for i, _ in ok if i % 50 == 0}:
        q = min(v for i, v in ok if i == qi)
        found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qi and len(v) == len(q))
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def run(spark, rows, schema="vec_id long, embedding array<float>, id string"):
    df = spark.createDataFrame([(*r, "x") for r in rows], schema)
    v = df.where(usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), scaled(F.col("embedding")).alias("vec"))
    return sorted(tuple(r) for r in top_k(v, v.where("id % 50 = 0"), query_block=2).collect())


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.RandomState(0)
    rows = [(i, [float(np.float32(x)) for x in rng.randn(64)]) for i in range(400)]
    rows += [(400, None), (401, [None] * 64), (402, [float("nan")] * 64), (450, [float("inf")] * 64), (403, []),
             (404, [1.0, 2.0]), (405, [3.0, -1.0]), (500, [1.0, 1.0]), (None, [1.0] * 64)]
    rows += [(600 + i, rows[50][1]) for i in range(8)]  # ties
    rows += [rows[7], rows[100]]  # repeated rows
    assert run(spark, rows) == brute(rows)


def test_fewer_rows_than_k_and_empty(spark):
    assert run(spark, [(0, [0.5] * 8), (1, [0.25] * 8)]) == [(0, 1, 1, 8 * 128 * 64)]
    assert run(spark, []) == []


def test_bounds_hold():
    rng = np.random.RandomState(1)
    x, q = rng.randint(-300, 300, (50, 64)), rng.randint(-300, 300, (20, 64))
    a, b = Segments(q), Segments(x)
    for level in range(len(a.levels)):
        assert (a.levels[level] @ b.levels[level].T >= q @ x.T - 1e-6).all()


def test_tiles_do_not_change_results_and_bound_memory(monkeypatch):
    import tracemalloc

    from spanshade.llm import topk_search as ts

    rng = np.random.RandomState(2)
    q, x = rng.randint(-300, 300, (4000, 64)), rng.randint(-300, 300, (2048, 64))
    best, peak = [], []
    for tile in (512, 4000):
        monkeypatch.setattr(ts, "TILE", tile)
        tracemalloc.start()
        b = ts.Best(np.arange(4000) + 10_000, q, 5)
        b.offer(np.arange(2048), x)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        best.append([(s.tolist(), v.tolist()) for s, v in zip(b.score, b.vec)])
    assert best[0] == best[1] and peak[0] < peak[1] / 3
    want = [sorted(((-int(s), i) for i, s in enumerate(row)))[:5] for row in (q[:50] @ x.T)]
    assert [[(-s, i) for s, i in zip(*b)] for b in best[0][:50]] == want
