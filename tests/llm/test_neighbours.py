"""Nearest neighbours: exact scores and order, recall, awkward rows."""

import math
import os

import numpy as np
import pytest

from landledger.llm import neighbours


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1.0)
            for i, v in zip(ids, vectors)]
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, part string, score double")


def clustered(n, seed=1, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, d))
    x = centres[rng.integers(0, 40, n)] + 0.3 * rng.standard_normal((n, d))
    return np.float32(x)


def brute(x, ids, query, k):
    scores = [(-float((np.float64(x[i]) * np.float64(x[query])).sum()), ids[i])
              for i in range(len(x)) if ids[i] != ids[query]]
    return sorted(scores)[:k]


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_recall_scores_and_order(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "SLICE", 10)
    x = clustered(1500)
    x[700:900] = x[3]  # a crowd of equal vectors
    found, ids = by_query(neighbours.nearest(table(spark, x), sample=800)), list(range(len(x)))
    assert sorted(found) == list(range(0, 1500, 20))
    hits = total = 0
    for query, rows in found.items():
        true = brute(x, ids, query, 20)
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        for _, v, score in rows:
            assert v != query
            assert score == pytest.approx(float(np.float64(x[v]) @ np.float64(x[query])), abs=1e-12)
        hits += len({v for _, v, _ in rows} & {v for _, v in true})
        total += len(true)
    assert hits / total >= 0.9
    assert [v for _, v, _ in found[700]] == [v for _, v in brute(x, ids, 700, 20)]


def test_router_searches_a_part_of_a_clustered_table():
    model = neighbours.learn(np.float64(clustered(2000)), 20_000, 20)
    assert model["parts"] == 32 or model["parts"] == 64
    assert model["search"] <= model["parts"] // 4


def test_halves_are_balanced():
    x = np.float64(clustered(512))
    label = neighbours._parts(neighbours._nearest(x, 8), 8, np.random.default_rng(1))
    assert np.bincount(label).tolist() == [64] * 8


def test_few_rows_give_all_candidates(spark):
    found = by_query(neighbours.nearest(table(spark, [[1, 0], [0, 1], [1, 1], [2, 2]])))
    assert found == {0: [(1, 3, 2.0), (2, 2, 1.0), (3, 1, 0.0)]}


def test_awkward_rows(spark):
    bad = [None, [], [0, 0], [1, None], [math.nan, 1], [math.inf, 1], [1, 2, 3]]
    good = [[1, 0], [1, 0], [1, 0], [0.5, 0]]
    rows = table(spark, [*good, [3, 3], *bad, [9, 9]], [0, 1, 2, 3, 3, *range(20, 34, 2), None])
    found = by_query(neighbours.nearest(rows))
    # the id that comes twice counts once, with the better of its vectors
    assert found == {0: [(1, 3, 3.0), (2, 1, 1.0), (3, 2, 1.0)]}
    assert neighbours.nearest(rows.where("false")).count() == 0
    assert neighbours.nearest(table(spark, [[1, 2]])).count() == 0


def test_recall_on_the_sample_table(spark):
    """Against exact search over the whole table, with fewer parts searched than there are."""
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").replace("0.001", "0.1")
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in neighbours.usable(table).withColumnRenamed(
        "vector", "embedding").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    found = {}
    for r in neighbours.nearest(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[ids == ids[q]] = -np.inf
        true = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        hits, total = hits + len(true & found.get(ids[q].item(), set())), total + len(true)
    assert hits >= 0.9 * total
