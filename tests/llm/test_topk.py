"""Exact search against all products, in one block and in many; and how much the bounds spare."""

from __future__ import annotations

import random

import numpy as np
import pytest

from shelfmark.llm import topk


@pytest.fixture(params=["as they are", "small blocks", "no ranges"])
def small(request, monkeypatch):
    """Sizes under which small tables have many blocks."""
    if request.param != "as they are":
        for name, value in {"QUERIES": 2, "CANDIDATES": 7, "CHUNK": 3, "SAMPLE": 20}.items():
            monkeypatch.setattr(topk, name, value)
    if request.param == "no ranges":
        monkeypatch.setattr(topk, "RANGES", 0)


def test_top_k_cases(spark, small):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(10)]) for i in range(0, 120)] + [(200, None), (250, [1.0] * 9), (300, [None] * 10), (350, [float("nan")] * 10), (None, [0.5] * 10), (400, [0.5] * 10), (401, [0.5] * 10), (402, [0.5] * 10)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    good = {i: np.floor(256.0 * np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = set()
    for q in good:
        if q % 50 == 0:
            best = sorted((-int(good[q] @ good[c]), c) for c in good if c != q and len(good[c]) == len(good[q]))[:5]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    assert {tuple(r) for r in topk.exact_top_k(table, "vec_id % 50 = 0", 5).collect()} == want
    assert topk.exact_top_k(table.limit(0), "vec_id % 50 = 0", 5).isEmpty()


def test_top_k_of_repeated_rows(spark, small):
    rng = random.Random(6)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(10)]
    rows = [(i, vector()) for i in range(120)]
    rows += [(i, v) for i, v in rows if i % 3 == 0 for _ in range(30)] + [(i, vector()) for i in range(0, 120, 5) for _ in range(3)] + [(50, [0.5] * 9), (7, [0.5] * 9)]
    best = {}
    whole = [(i, np.floor(256.0 * np.array(v, np.float32).astype(float))) for i, v in rows]
    for q, x in whole:
        for c, y in whole:
            if q % 50 == 0 and c != q and len(x) == len(y):
                best[q, c] = max(best.get((q, c), int(x @ y)), int(x @ y))
    want = set()
    for q in (0, 50, 100):
        want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted((-s, c) for (p, c), s in best.items() if p == q)[:5])}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    got = topk.exact_top_k(table, "vec_id % 50 = 0", 5).collect()
    assert len(got) == 15 and {tuple(r) for r in got} == want


def test_large_components_are_exact(spark):
    rows = [(i, [1e12 * ((i * 7 + j) % 5 - 2) + i for j in range(6)]) for i in range(60)]
    whole = {i: [int(np.floor(256.0 * x)) for x in v] for i, v in rows}
    want = set()
    for q in (0, 50):
        found = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in whole if c != q)[:2]
        want |= {(q, n + 1, c) for n, (_, c) in enumerate(found)}
    # such scores are beyond 64 bits; smaller ones show the exact sums
    table = spark.createDataFrame([(i, [x / 1e9 * 1024 for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    scaled = {r["vec_id"]: [int(np.floor(256.0 * x)) for x in r["embedding"]] for r in table.collect()}
    want = set()
    for q in (0, 50):
        found = sorted((-sum(a * b for a, b in zip(scaled[q], scaled[c], strict=True)), c) for c in scaled if c != q)[:2]
        want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(found)}
    assert {tuple(r) for r in topk.exact_top_k(table, "vec_id % 50 = 0", 2).collect()} == want


def test_own_names_of_columns(spark):
    rows = [(i, [float(i % 7), 1.0], 3) for i in range(40)]
    table = spark.createDataFrame(rows, "`a.id` long, `the vector` array<double>, vec_id int")
    got = topk.exact_top_k(table, "`a.id` % 10 = 3 and vec_id = 3", 1, "a.id", "the vector").collect()
    assert sorted(r["query_id"] for r in got) == [3, 13, 23, 33]


def clustered(n, dim, clusters, spread):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(clusters, dim)) * 60
    return np.floor(centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * spread), np.arange(n)


def test_bounds_spare_most_products_of_clustered_vectors():
    vectors, ids = clustered(6000, 64, 60, 6)
    queries, query_ids = vectors[:200], ids[:200]
    floor, tally = topk.first_floors(queries, query_ids, vectors[-600:], ids[-600:], 5), {}
    best: dict[int, list] = {}
    for n in range(0, 6000, 2000):
        for q, i, s in topk.search_block(queries, query_ids, vectors[n : n + 2000], ids[n : n + 2000], 5, floor, tally):
            best.setdefault(q, []).append((-s, i))
    whole = vectors @ queries.T
    for q in range(200):
        assert sorted(best[q])[:5] == sorted((-int(whole[c, q]), c) for c in range(6000) if c != q)[:5]
    assert tally["pairs"] == 1_200_000 and tally["exact"] < 0.05 * tally["pairs"]


def test_few_candidates_are_shipped_to_blocks_of_near_queries():
    vectors, ids = clustered(6000, 64, 60, 6)
    near = np.argsort(((vectors - vectors[0]) ** 2).sum(1))[:50]  # the queries of one cell
    floor = topk.first_floors(vectors[near], ids[near], vectors[:600], ids[:600], 5)
    good = topk.wanted(vectors, topk.ranges_of(vectors[near], floor)[None])[:, 0]
    scores = vectors @ vectors[near].T
    for n, q in enumerate(near):
        order = [c for c in np.lexsort((ids, -scores[:, n])) if c != q][:5]
        assert good[order].all()
    assert good.mean() < 0.2
