"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adspindle.llm.text import in_task, mix
from adspindle.sources.workspace import Workspace

NEIGHBOURS = 20
# The tree is fitted on at most so many vectors, those with the smallest hash of their ids.
FIT_ROWS = 16_384
BRANCHES = 16
# Leaves grow as the square root of the table, up to a tree that is still a small broadcast.
LEAVES_PER_ROOT = 2.0
MOST_LEAVES = 4096
# A leaf with more vectors is searched in pieces.
PIECE_ROWS = 2048
# Recall is calibrated on so many queries, against all vectors.
CALIBRATION = 256
RECALL = 0.95
FIRST_LEAVES, WIDEN = 4, 2
# Beyond any rounding error of a double inner product of unit-sized vectors, relative to their norms.
SLACK = 1e-9


@dataclass(frozen=True)
class Tree:
    """Centres of all nodes, children of inner nodes, and for leaves their number (-1 for inner nodes)."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    @staticmethod
    def fit(points: np.ndarray, leaves: int) -> Tree:
        """Splits the node with the most points into k-means clusters until there are ``leaves`` leaves."""
        centres, children = [points.mean(axis=0)], [[]]
        open_ = [(-len(points), 0, np.arange(len(points)))]
        while open_ and len(centres) - sum(bool(c) for c in children) < leaves:
            _, node, own = heapq.heappop(open_)
            parts = _kmeans(points[own], min(BRANCHES, max(2, leaves)))
            if len(parts) < 2:
                continue
            for part in parts:
                children[node].append(len(centres))
                heapq.heappush(open_, (-len(part), len(centres), own[part]))
                centres.append(points[own[part]].mean(axis=0))
                children.append([])
        leaf, number = np.full(len(centres), -1), 0
        for i, below in enumerate(children):
            if not below:
                leaf[i], number = number, number + 1
        return Tree(np.array(centres), children, leaf)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: down from the root to the nearest child."""
        out = np.zeros(len(points), dtype=np.int64)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, own = waiting.pop()
            below = self.children[node]
            if not below:
                out[own] = self.leaf[node]
                continue
            near = _nearest(points[own], self.centres[below])
            waiting += [(child, own[near == i]) for i, child in enumerate(below) if (near == i).any()]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves of a best-bin-first search.

        A priority queue holds the nodes seen but not entered, by their centre's inner product with the
        query; the best is entered next, whether it is a leaf or has children to be queued.
        """
        scores = self.centres @ query
        queue, found = [(-float(scores[0]), 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                found.append(int(self.leaf[node]))
            for child in self.children[node]:
                heapq.heappush(queue, (-float(scores[child]), child))
        return found


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _kmeans(points: np.ndarray, k: int, rounds: int = 8) -> list[np.ndarray]:
    """Clusters as row numbers, from centres spread over the points; deterministic, no cluster is empty."""
    if len(points) < 2:
        return [np.arange(len(points))]
    order = np.argsort(mix(np.arange(len(points), dtype=np.uint64)))
    centres = np.unique(points[order[: min(k, len(points))]], axis=0)
    for _ in range(rounds):
        near = _nearest(points, centres)
        centres = np.array([points[near == i].mean(axis=0) for i in np.unique(near)])
    near = _nearest(points, centres)
    return [np.flatnonzero(near == i) for i in np.unique(near)]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    """The correctly rounded inner product: products of two floats are exact in double, and so is their sum."""
    return math.fsum((a * b).tolist())


def _best(scores: np.ndarray, ids: np.ndarray, query: np.ndarray, vectors: np.ndarray, own: int, least: float, k: int):
    """The ``k`` best ``(score, id)`` by exact score, then smaller id, of at least ``least``, without ``own``."""
    slack = SLACK * (1 + np.abs(scores).max(initial=0.0))
    if len(scores) > k + 1:
        least = max(least, float(np.partition(scores, -(k + 1))[-(k + 1)]))
    near = np.flatnonzero((scores >= least - slack) & (ids != own))
    ranked = sorted((-_exact(query, vectors[i]), int(ids[i])) for i in near)
    return [(-s, i) for s, i in ranked[:k]]


def _in_order(embedding: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, and not all zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def _usable(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Vectors of the most common length, and that length; of equal vectors the ``k + 1`` smallest ids.

    A vector's ``k`` nearest can't hold more of them: those with smaller ids win the ties.
    """
    sizes = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "dim").first()
    dim = common["dim"] if common else 1
    vectors = vectors.where(F.size("embedding") == dim)
    # Once within a few parts of each vector's rows, so that a vector with very many rows is spread.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(16))
    for part in ([salt], []):
        order = Window.partitionBy("embedding", *part).orderBy("vec_id")
        vectors = vectors.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k + 1).drop("__n")
    return vectors, dim


def _hashed(column: str) -> Column:
    return F.xxhash64(F.lit("neighbours"), column)


def nearest_neighbours(
    table: DataFrame,
    queries: Column,
    workspace: Workspace,
    k: int = NEIGHBOURS,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each row that fits ``queries``.

    Nearness is the inner product in double precision, ties go to the smaller id, and a vector is no
    neighbour of its own row. Every vector is placed in a leaf of a k-means tree. A query visits leaves
    best bin first, and scans them whole. How many leaves, the same number for all queries, is widened
    until on calibration queries, compared with all vectors, ``recall`` of the true neighbours lie in
    visited leaves. Leaves are visited in rounds, few at first; the nearest so far give each query a bound,
    and only vectors that reach it are sent on. Queries whose leaves hold fewer than ``k`` vectors go on
    alone, so every query finds ``k`` where there are so many.

    The tree is fitted on at most ``FIT_ROWS`` vectors and holds ``MOST_LEAVES`` leaves at most, so it
    can be sent to all tasks; leaves are scanned in pieces of bounded size. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do those of another length than most,
    nor rows without an id. Of equal vectors those with the smallest ids are found first. Repeated rows
    of one id count as one, with the smallest of their vectors. With fewer than ``k`` other vectors all are returned; an empty table gives
    no rows. Only ``vec_id`` and ``embedding`` are read.
    """
    vectors = table.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    vectors = vectors.where(F.col("vec_id").isNotNull() & _in_order(F.col("embedding")))
    single, _ = workspace.save(vectors.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "single")
    usable, dim = _usable(single, k)
    vectors, seen = workspace.save(usable, "vectors")
    asked, n_asked = workspace.save(single.where(queries & (F.size("embedding") == dim)), "queries")
    count = seen["rows"]
    sample = vectors.orderBy(_hashed("vec_id"), "vec_id").limit(FIT_ROWS).select("embedding").collect()
    if not sample or not n_asked["rows"]:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    leaves = int(min(MOST_LEAVES, max(1, LEAVES_PER_ROOT * math.sqrt(count))))
    tree = Tree.fit(np.array([r[0] for r in sample], dtype=np.float64), leaves)
    placed, _ = workspace.save(_placed(vectors, tree, dim), "leaves")
    most = _calibrate(placed, asked, tree, dim, k, recall)
    return _search(placed, asked, tree, dim, k, most, workspace)


def _placed(vectors: DataFrame, tree: Tree, dim: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.place(_matrix(batch.column("embedding"), dim))
            yield batch.append_column("leaf", pa.array(leaf.astype(np.int32)))

    found = vectors.mapInArrow(in_task(place), "vec_id bigint, embedding array<float>, leaf int")
    sizes = found.groupBy(F.col("leaf").alias("__leaf")).agg(F.ceil(F.count(F.lit(1)) / PIECE_ROWS).alias("__pieces"))
    joined = found.join(F.broadcast(sizes), F.col("leaf") == F.col("__leaf"))
    piece = F.pmod(F.xxhash64("vec_id"), F.col("__pieces")).cast("int")
    return joined.select("vec_id", "embedding", "leaf", piece.alias("piece"))


def _calibrate(placed: DataFrame, asked: DataFrame, tree: Tree, dim: int, k: int, recall: float) -> int:
    """The number of leaves that hold ``recall`` of the true neighbours of the calibration queries."""
    rows = asked.orderBy(_hashed("vec_id"), "vec_id").limit(CALIBRATION).collect()
    ids = [r["vec_id"] for r in rows]
    points = np.array([r["embedding"] for r in rows], dtype=np.float64)

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in ids]
        for batch in batches:
            vectors = _matrix(batch.column("embedding"), dim)
            own = batch.column("vec_id").to_numpy(zero_copy_only=False)
            leaf = dict(zip(own.tolist(), batch.column("leaf").to_pylist()))
            scores = points @ vectors.T
            for q, row in enumerate(scores):
                least = best[q][-1][0] if len(best[q]) == k else -np.inf
                new = [(s, i, leaf[i]) for s, i in _best(row, own, points[q], vectors, ids[q], least, k)]
                best[q] = sorted(best[q] + new, key=lambda e: (-e[0], e[1]))[:k]
        flat = [(q, s, i, f) for q, found in enumerate(best) for s, i, f in found]
        columns = zip(*flat) if flat else ([], [], [], [])
        kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["q", "score", "vec_id", "leaf"]
        )

    found = placed.select("vec_id", "embedding", "leaf").mapInArrow(in_task(truth), "q int, score double, vec_id bigint, leaf int")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    nearest = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("q", "leaf").collect()
    # At which visit each true neighbour's leaf comes; widened by doubling, so few searches go far.
    turns, most = None, FIRST_LEAVES
    while True:
        most = min(most * 2, tree.leaves)
        visits = [{leaf: n for n, leaf in enumerate(tree.visit(p, most))} for p in points]
        turns = np.array([visits[r["q"]].get(r["leaf"], tree.leaves) for r in nearest])
        if most == tree.leaves or (turns < most).mean() >= recall:
            break
    return visits_for(turns, recall)


def visits_for(turns: np.ndarray, recall: float) -> int:
    """How many visits reach ``recall`` of all, if each is reached at its turn, counted from 0."""
    return int(np.sort(turns)[max(0, math.ceil(recall * len(turns)) - 1)]) + 1 if len(turns) else 1


def _visits(asked: DataFrame, tree: Tree, dim: int, begin: int, end: int) -> DataFrame:
    """One row per query and visited leaf, from the search's visit ``begin`` up to ``end``."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [tree.visit(p, end)[begin:] for p in _matrix(batch.column("embedding"), dim)]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                made = batch.take(rows)
                yield made.append_column("leaf", pa.array([x for f in found for x in f], pa.int32()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.mapInArrow(in_task(visit), f"{kinds}, leaf int")


def _scan(placed: DataFrame, visits: DataFrame, dim: int, k: int) -> DataFrame:
    """Candidates ``query_id, vec_id, score``: of each visited piece of a leaf a query's best that reach its bound.

    Vectors and queries of a piece meet in one task, the vectors first; queries pass by them in batches,
    so however many visit a leaf, only its piece is held.
    """
    pieces = placed.groupBy("leaf").agg((F.max("piece") + 1).alias("__pieces"))
    to_all = visits.join(F.broadcast(pieces), "leaf")
    to_all = to_all.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1)))
    names = ["leaf", "piece", "kind", "vec_id", "embedding", "bound"]
    both = placed.withColumns({"kind": F.lit(0), "bound": F.lit(0.0)}).select(*names)
    both = both.unionByName(to_all.withColumn("kind", F.lit(1)).select(*names))
    both = both.repartition("leaf", "piece").sortWithinPartitions("leaf", "piece", "kind")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors = None, None, None
        for batch in batches:
            points, bound = _matrix(batch.column("embedding"), dim), batch.column("bound").to_pylist()
            leaf, piece, kind, own = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("leaf", "piece", "kind", "vec_id")
            )
            change = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(piece) != 0) | (np.diff(kind) != 0)) + 1
            out: list[tuple] = []
            for run in np.split(np.arange(len(leaf)), change):
                if not len(run):
                    continue
                here = (leaf[run[0]], piece[run[0]])
                if kind[run[0]] == 0:
                    if here == at:
                        ids, vectors = np.concatenate([ids, own[run]]), np.concatenate([vectors, points[run]])
                    else:
                        at, ids, vectors = here, own[run], points[run]
                elif here == at:
                    for block in np.array_split(run, -(-len(run) // 1024)):
                        scores = points[block] @ vectors.T
                        for row, q in zip(scores, block):
                            found = _best(row, ids, points[q], vectors, own[q], bound[q], k)
                            out += [(int(own[q]), i, s) for s, i in found]
            columns = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
                names=["query_id", "vec_id", "score"],
            )

    return both.mapInArrow(in_task(scan), "query_id bigint, vec_id bigint, score double")


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(placed: DataFrame, asked: DataFrame, tree: Tree, dim: int, k: int, most: int, workspace: Workspace) -> DataFrame:
    """Visits in rounds, each ``WIDEN`` times as many leaves as before, with the bound that the last one left.

    So a round brings a query a few times ``k`` candidates, however large the table. After ``most`` leaves
    only queries that have found fewer than ``k`` vectors go on, until they have them or have seen all leaves.
    """
    near, begin, end = None, 0, min(FIRST_LEAVES, most)
    while True:
        known = asked.withColumn("bound", F.lit(float("-inf")))
        if near is not None:
            bounds = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("__bound"))
            known = known.join(bounds, F.col("vec_id") == F.col("query_id"), "left")
            known = known.select("vec_id", "embedding", F.coalesce("__bound", "bound").alias("bound"))
        visits, here = _visits(known, tree, dim, begin, end), placed
        if begin >= most:
            visits, _ = workspace.save(visits, "visits")
            # As many rows as there are leaves, at most.
            here = placed.join(F.broadcast(visits.select("leaf").distinct()), "leaf", "left_semi")
        found = _scan(here, visits, dim, k)
        near, _ = workspace.save(_ranked(found if near is None else near.drop("rank").unionByName(found), k), "near")
        if end >= tree.leaves:
            return near
        if end >= most:
            full = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
            asked, short = workspace.save(asked.join(full, "vec_id", "left_anti").select(*asked.columns), "short")
            if not short["rows"]:
                return near
        begin, end = end, min(end * WIDEN, most if end < most else tree.leaves)
