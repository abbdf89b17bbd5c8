"""Exact search against all scores."""

import numpy as np

from corvane.llm import topk


def brute(ids, vectors, query, k, skip):
    scores = vectors @ query
    rows = sorted((-int(s), int(i)) for i, s in zip(ids, scores, strict=True) if i != skip)
    return [(i, -s) for s, i in rows[:k]]


def test_index_is_exact():
    rng = np.random.default_rng(1)
    for n, dims, spread in ((1, 3, 5), (4, 2, 1), (300, 8, 3), (900, 16, 300), (400, 5, 1), (300, 8, 1 << 24)):
        vectors = rng.integers(-spread, spread + 1, (n, dims))
        vectors[n // 2 :] = vectors[: n - n // 2] if n % 2 == 0 else vectors[n // 2 :]
        ids = rng.permutation(n) * 3
        index = topk.Index(ids, vectors)
        for _ in range(30):
            query = rng.integers(-spread, spread + 1, dims)
            skip = int(rng.choice(ids))
            assert index.top(query, 5, skip) == brute(ids, vectors, query, 5, skip)
            assert index.top(query, 3, None) == brute(ids, vectors, query, 3, None)


def test_search_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 50)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(2)
    rows = [(int(k), [float(x) for x in rng.normal(size=6)], 1) for k in range(200)]
    rows += [(200, rows[0][1], 1), (201, None, 1), (202, [None] * 6, 1), (203, [float("nan")] * 6, 1), (204, [float("inf")] * 6, 1), (None, rows[0][1], 1), (205, [], 1), (206, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(5)
    vectors = topk.integer_vectors(df, "embedding")
    got = {}
    for r in topk.search(vectors.filter("vec_id % 10 = 0"), vectors).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ids = np.arange(201)
    whole = np.array([np.floor(256 * np.array(rows[k][1], np.float32).astype(float)) for k in range(201)]).astype(int)
    assert set(got) == set(range(0, 201, 10))
    for q in range(0, 201, 10):
        assert [got[q][k] for k in range(1, 6)] == brute(ids, whole, whole[q], 5, q)


def test_large_values(spark):
    """Components whose products no long holds leave the true scores of others alone."""
    big = 1 << 40
    rows = [(k, [k - 20, 3 * k % 7, -k]) for k in range(40)] + [(100, [big, 1, 0]), (102, [0, big, 5]), (104, [1 << 62, -(1 << 62), 9])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = {}
    for r in topk.search(df.filter("vec_id % 2 = 0"), df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    most = (1 << 63) - 1
    for key, query in rows:
        if key % 2 == 0:
            scores = [(i, sum(a * b for a, b in zip(query, v))) for i, v in rows if i != key]
            want = sorted((-min(max(s, -most - 1), most), i) for i, s in scores)[:5]
            assert sorted(got[key]) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_nothing(spark):
    none = topk.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), "embedding")
    assert topk.search(none, none).collect() == []
