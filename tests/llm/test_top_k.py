"""Exact top-k against all pairs in plain Python; the bounds lose no pair."""

import numpy as np
from pyspark.sql import functions as F

from kempt.llm import top_k


def brute(rows, k=10, scale=1024):
    good = []
    for r, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((r, i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    out = []
    for r, i, v in good:
        if i is not None and i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for s, j, w in good if s != r)
            out += [(i, n, None if null else j, -score) for n, (score, null, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, parts=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(parts)
    out = top_k.top_k(df, F.col("vec_id") % 100 == 0, **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted([tuple(r) for r in out.collect()], key=str)


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, d)) * (0.5 ** np.arange(d))
    x = centres[rng.integers(0, 7, n)] * rng.uniform(0.1, 2, (n, 1)) + rng.normal(size=(n, d)) * 0.05
    return x.astype(np.float32)


def test_equals_all_pairs(spark):
    x = clustered(700, 16, 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows, seeds=40) == brute(rows)
    assert run(spark, rows, seeds=3, block_bytes=16 * 8 * 3) == brute(rows)  # fewer first rows than k; three blocks


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 2.0]), (200, None), (300, [1.0, None]),
            (400, [nan, 1.0]), (500, [inf, 0.0]), (600, []), (700, [-3.0]), (8, [0.5, 0.5, 9.0]), (9, [-1.0, -1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=2) == brute(rows, k=2)
    assert run(spark, [(100, [1.0])]) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == [] and run(spark, []) == []


def test_one_vector_is_most_of_the_table(spark):
    rows = [(i, [0.25, 0.5, -0.25]) for i in range(400)] + [(1000 + i, [0.25, 0.5 + i / 64, 0.1]) for i in range(30)]
    assert run(spark, rows, seeds=50) == brute(rows)


def test_bounds_spare_most_pairs():
    x = np.floor(1024 * clustered(4000, 64, 2)).astype(np.int64)
    x = x[np.argsort(-(x ** 2).sum(1))]
    axes = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    rid = np.arange(len(x))
    scores = top_k.exact_scores(x[:100], x[:500])
    scores[rid[:100, None] == rid[None, :500]] = -1 << 62
    search = top_k.Search(rid[:100], x[:100], np.sort(scores, 1)[:, -10], axes, 10)
    scored = sum(search.add(rid[i:i + 500], rid[i:i + 500], x[i:i + 500], np.sqrt((x[i:i + 500] ** 2).sum(1))) for i in range(0, len(x), 500))
    assert scored < 0.1 * 100 * len(x)


def test_large_components_are_exact_integers():
    q = np.array([[1 << 30, 3]])
    assert top_k.exact_scores(q, np.array([[(1 << 30) + 1, 1]])).tolist() == [[(1 << 60) + (1 << 30) + 3]]
