"""Exact top-k search by inner product with dual cover trees.

Vectors are whole numbers (``floor(1024 * x)``). Queries and candidates are dealt
into blocks of fixed size; every block gets a cover tree, and every query block
meets every candidate block once, in a task that holds these two alone. There,
both trees are walked together: a pair of nodes with centres a, b and covering radii
r, s cannot score above

    <a, b> + r |b| + s |a| + r s

and is left if that is below the worst k-th score of the queries in the group. The
k best of each pair of blocks are merged per query by a window that each task
cuts to k rows before the shuffle.

Equal vectors of a block are one point of its tree; as ties go to the smaller id, and
a query passes over one id, its own, only their 2 k smallest ids matter, each k times at
most. Scores are exact: products are summed in doubles
while no sum can reach 2**53, else as Python integers (a score beyond a long
raises an error).

Rows with a NULL id take no part, nor do vectors that are NULL or hold NULL or
non-finite components. Vectors of different lengths have no inner product and never
meet. A query's own row is every row with its id; repeated rows are candidates
one by one, in any order. An id asks once, however many rows it has: of different vectors
the first in order asks (arrays compare component by component, a shorter one first).
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradmill.llm.tables import kept

SCALE = 1024
K = 10
#: Rows in a block of candidates, and of queries.
BLOCK = 4096
QUERY_BLOCK = 1024
#: Parts into which the pairing of block numbers is dealt.
PARTS = 64
#: A node of so many points is not split further.
LEAF = 256
#: Children of a node at most; with many dimensions more would be needed to halve the radius.
FAN = 8
_EXACT = float(1 << 52)


# --- trees ----------------------------------------------------------------------


class Tree:
    """A cover tree over the rows of ``x``: nodes with a centre, a radius and children.

    A node's centre is one of its points. Its points go to the nearest of the
    children's centres, which lie further apart than half its radius; up to ``FAN`` of
    them, so that the radius may shrink less where the space has many dimensions.
    ``rows`` lists the points so that every node has a contiguous stretch.
    """

    def __init__(self, x: np.ndarray):
        self.x, self.rows = x, np.arange(len(x))
        self.centre, self.radius, self.begin, self.end, self.children = [], [], [], [], []
        if len(x):
            self._node(0, len(x))
        self.centre = x[np.array(self.centre, np.int64)]
        self.radius = np.array(self.radius) * (1 + 1e-9)
        self.length = np.sqrt((self.centre**2).sum(1)) * (1 + 1e-9)
        self.x = x[self.rows]

    def _node(self, begin: int, end: int) -> None:
        todo = [(begin, end, None)]
        while todo:
            begin, end, parent = todo.pop()
            at = len(self.centre)
            own = self.rows[begin:end]
            apart = _distances(self.x[own], self.x[own[0]])
            self.centre.append(own[0])
            self.radius.append(float(apart.max()))
            self.begin.append(begin)
            self.end.append(end)
            self.children.append([])
            if parent is not None:
                self.children[parent].append(at)
            if end - begin <= LEAF or self.radius[-1] == 0:
                continue
            # the farthest point becomes the next centre, until all are covered within half the radius
            half, of, centres = self.radius[-1] / 2, np.zeros(len(own), np.int64), [0]
            while len(centres) < FAN and apart.max() > half:
                new = int(apart.argmax())
                there = _distances(self.x[own], self.x[own[new]])
                of[there < apart] = len(centres)
                apart = np.minimum(apart, there)
                centres.append(new)
            parts = [own[np.append(c, np.setdiff1d(np.flatnonzero(of == n), c))] for n, c in enumerate(centres)]
            self.rows[begin:end] = np.concatenate(parts)
            for part in parts:
                todo.append((begin, begin + len(part), at))
                begin += len(part)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


def _bounds(a: Tree, i: np.ndarray, b: Tree, j: np.ndarray) -> np.ndarray:
    """The highest score any pair of points below nodes ``i`` and ``j`` can have, for each pair."""
    r, s = a.radius[i], b.radius[j]
    dot = np.einsum("nd,nd->n", a.centre[i], b.centre[j])
    return dot + r * b.length[j] + s * a.length[i] + r * s + 1e-6 * np.abs(dot) + 1.0


class Best:
    """The ``k`` best ``(score, id)`` per query so far; ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.k = k

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[rows], score], 1)
        ids = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), ids.shape[-1]))], 1)
        order = np.lexsort((ids, -score), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.id[rows] = np.take_along_axis(ids, order, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int = K):
    """``(query rows, ids, scores)`` of the best of one block for the queries of another.

    ``queries`` and ``points`` are arrays of whole numbers (doubles or Python integers).
    """
    best = Best(len(queries), k)
    if not len(queries) or not len(points):
        return _listed(best)
    longest = max(float(np.abs(x).max(initial=0)) for x in (queries, points))
    if queries.dtype == object or points.dtype == object or longest**2 * queries.shape[1] >= _EXACT:
        return _plain(queries, query_ids, points, ids, k)
    order = np.argsort(ids, kind="stable")
    points, ids = points[order], ids[order]
    distinct, of = np.unique(points, axis=0, return_inverse=True)
    by = np.argsort(of.ravel(), kind="stable")  # ids of one point in order
    by = by[_run_places(of.ravel()[by], ids[by]) < k]
    by = by[_run_places(of.ravel()[by]) < 2 * k]
    first = np.searchsorted(of.ravel()[by], np.arange(len(distinct) + 1))
    p, q = Tree(distinct), Tree(queries)
    bound = _bounds(q, np.array([0]), p, np.array([0]))[0]
    todo = [(bound, 0, 0)]
    while todo:
        bound, i, j = todo.pop()
        rows = q.rows[q.begin[i]:q.end[i]]
        if bound < best.score[rows, -1].min():
            continue
        wide = q.children[i] and (not p.children[j] or q.radius[i] > p.radius[j])
        if wide or p.children[j]:
            a = np.array(q.children[i] if wide else [i] * len(p.children[j]))
            b = np.array([j] * len(a) if wide else p.children[j])
            reach = _bounds(q, a, p, b)
            for n in np.argsort(reach, kind="stable"):  # the best pair is taken next
                todo.append((reach[n], int(a[n]), int(b[n])))
            continue
        here = p.rows[p.begin[j]:p.end[j]]
        score = q.x[q.begin[i]:q.end[i]] @ p.x[p.begin[j]:p.end[j]].T
        members = [by[first[d]:first[d + 1]] for d in here]
        column = np.repeat(np.arange(len(here)), [len(m) for m in members])
        found = ids[np.concatenate(members)]
        good = (score >= best.score[rows, -1][:, None]).any(0)[column]
        column, found = column[good], found[good]
        if not len(found):
            continue
        score = score[:, column]
        score[query_ids[rows][:, None] == found[None, :]] = -np.inf
        best.add(rows, score, found)
    return _listed(best)


def _run_places(*keys: np.ndarray) -> np.ndarray:
    """The place of every row in its run of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))
    begin = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(begin, np.diff(np.append(begin, len(new))))


def _listed(best: Best):
    row, place = np.nonzero(best.score > -np.inf)
    return row, best.id[row, place], best.score[row, place].astype(np.int64)


def _plain(queries, query_ids, points, ids, k):
    """All pairs in Python integers, for numbers too large for doubles."""
    a, b = ([[int(v) for v in x] for x in m] for m in (queries, points))
    row, found, score = [], [], []
    for n, q in enumerate(a):
        scored = ((-sum(x * y for x, y in zip(q, p)), int(i)) for p, i in zip(b, ids) if i != query_ids[n])
        for s, i in sorted(scored)[:k]:
            row.append(n)
            found.append(i)
            score.append(-s)
    return np.array(row, np.int64), np.array(found, np.int64), np.array(score, object)


# --- the job --------------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: rows that take part, components as doubles."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))


def _blocks(rows: DataFrame, size: int, purpose: str) -> DataFrame:
    """``(block, dim, ids, x)``: at most ``size`` rows of one length each, as binary columns."""

    def run(batches):
        held: dict[int, list] = {}
        number, task = 0, TaskContext.get().partitionId()

        def block(dim, part):
            nonlocal number
            number += 1
            ids = np.array([i for i, _ in part], np.int64)
            x = np.floor(np.array([v for _, v in part], np.float64).reshape(len(part), dim) * SCALE)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number]), pa.array([dim]), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([x.tobytes()], pa.binary())], ["block", "dim", "ids", "x"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = held.setdefault(len(v), [])
                part.append((i, v))
                if len(part) == size:
                    yield block(len(v), held.pop(len(v)))
        for dim, part in held.items():
            yield block(dim, part)

    rows = rows.repartition(max(1, -(-rows.count() // size)))  # full blocks, however the input was cut
    return kept(rows.mapInArrow(run, "block long, dim long, ids binary, x binary"), purpose)


def _arrays(ids: bytes, x: bytes, dim: int):
    ids = np.frombuffer(ids, np.int64)
    x = np.frombuffer(x, np.float64).reshape(len(ids), dim)
    # beyond 2**53 a double is still a whole number, but sums need Python's
    return ids, x


def top_k(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``(vec_id, x)`` where ``is_query`` holds."""
    points = _blocks(vectors, block, "vector-blocks")
    once = vectors.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    asked = _blocks(once, query_block, "query-blocks")
    # every query block to every block of the same length: the stated queries against all rows
    places = points.select("dim", F.pmod("block", F.lit(PARTS)).alias("part"), "block")
    sides = asked.select("dim", F.col("block").alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    sent = asked.select(F.col("block").alias("asked"), F.col("ids").alias("query_ids"), F.col("x").alias("queries"))
    pairs = sides.join(places, ["dim", "part"]).join(sent, "asked").join(points.select("block", "ids", "x"), "block")
    n = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                query_ids, queries = _arrays(r["query_ids"], r["queries"], r["dim"])
                ids, x = _arrays(r["ids"], r["x"], r["dim"])
                row, found, score = search(queries, query_ids, x, ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row]), pa.array(found), pa.array(score.tolist(), pa.int64())],
                    ["query_id", "vec_id", "score"])

    met = pairs.repartition(n, "asked", "block").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
