import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adspindle.llm import neighbours
from adspindle.llm.neighbours import Tree, nearest_neighbours
from adspindle.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def exact(rows, query, k):
    ids, vectors = zip(*rows)
    q = vectors[ids.index(query)]
    scored = [(-math.fsum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != query]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_recall_of_the_query(spark):
    found = QUERIES["op2_nearest_neighbours"](spark, SF).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by_query) == {i for i, _ in rows if i % 20 == 0}
    hits = 0
    vectors = dict(rows)
    for query, got in by_query.items():
        assert [g[0] for g in got] == list(range(1, 21))
        hits += len({i for i, _ in exact(rows, query, 20)} & {g[1] for g in got})
        for (_, i, s), (_, j, t) in zip(got, got[1:]):
            assert s > t or (s == t and i < j)
        assert got[0][2] == math.fsum(a * b for a, b in zip(vectors[query], vectors[got[0][1]]))
    assert hits >= 0.9 * 20 * len(by_query)


def test_small_and_odd_tables(spark, ws):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (20, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (40, [0.0, 0.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (-20, [1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    found = nearest_neighbours(table, F.col("vec_id") % 20 == 0, ws)
    usable = [(i, v) for i, v in dict(rows).items() if i in (-20, 0, 1, 2, 20)]
    want = [(q, n + 1, i, s) for q in (-20, 0, 20) for n, (i, s) in enumerate(exact(usable, q, 20))]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert nearest_neighbours(table.limit(0), F.col("vec_id") % 20 == 0, ws).count() == 0
    assert nearest_neighbours(table, F.col("vec_id") == 3, ws).count() == 0


@pytest.mark.parametrize("pieces", [2048, 16])
def test_ties_and_hot_vectors(spark, ws, monkeypatch, pieces):
    monkeypatch.setattr(neighbours, "PIECE_ROWS", pieces)
    rng = np.random.default_rng(1)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=3).astype(np.float32).tolist()) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nearest_neighbours(table, F.col("vec_id") % 60 == 0, ws, recall=1.0)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for query, rows_found in got.items():
        assert [(i, s) for _, i, s in sorted(rows_found)] == exact(rows, query, 20)


def test_tree_visits_every_leaf_once_and_best_first():
    points = np.random.default_rng(3).normal(size=(900, 8))
    tree = Tree.fit(points, 40)
    visits = tree.visit(points[0], tree.leaves)
    assert sorted(visits) == list(range(tree.leaves)) and tree.leaves >= 40
    assert tree.visit(points[0], 7) == visits[:7]
    assert set(tree.place(points)) <= set(range(tree.leaves))
    assert Tree.fit(np.ones((50, 4)), 10).leaves == 1


def test_calibration_counts_the_visits_it_needs():
    # Nineteen of twenty lie in the first two leaves; the last is in no visited one.
    turns = np.array([0] * 10 + [1] * 9 + [180])
    assert neighbours.visits_for(turns, 0.95) == 2
    assert neighbours.visits_for(turns, 0.951) == 181
    assert neighbours.visits_for(turns, 0.5) == 1
    assert neighbours.visits_for(np.zeros(0), 0.95) == 1


def test_clusters_and_lone_vectors_at_the_default_recall(spark, ws, monkeypatch):
    """Tight clusters need few leaves, and queries in leaves with few vectors go on until they have enough."""
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(150, 16))
    tight = np.concatenate([middles[rng.integers(0, 150, 8000)] + rng.normal(size=(8000, 16)) * 0.02, np.zeros((8000, 16))], axis=1)
    lone = np.concatenate([np.zeros((40, 16)), rng.normal(size=(40, 16)) * 40], axis=1)
    points = np.concatenate([tight, lone])[rng.permutation(8040)].astype(np.float32)
    table = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id long, embedding array<float>")
    most = []
    calibrate = neighbours._calibrate

    def watched(placed, asked, tree, *rest):
        most.append((calibrate(placed, asked, tree, *rest), tree.leaves))
        return most[-1][0]

    monkeypatch.setattr(neighbours, "_calibrate", watched)
    got = {}
    for r in nearest_neighbours(table, F.col("vec_id") % 20 == 0, ws).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert most[0][0] < most[0][1] / 4
    assert set(got) == set(range(0, 8040, 20))
    wide, hits = points.astype(np.float64), 0
    for query, found in got.items():
        assert sorted(r for r, _ in found) == list(range(1, 21))
        scores = wide @ wide[query]
        scores[query] = -np.inf
        hits += len(set(np.lexsort((np.arange(8040), -scores))[:20].tolist()) & {i for _, i in found})
    assert hits >= 0.9 * 20 * len(got)
