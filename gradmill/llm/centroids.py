"""Centroid clustering (Lloyd's rounds) in whole numbers, assigned through a vantage-point tree.

Vectors are whole numbers (``floor(256 * x)``), written once. In every round a
vantage-point tree is built over the centroids on the driver and broadcast; its size is
that of the centroids, ``k * dim`` numbers, and checked against ``MAX_NUMBERS``. Tasks
search it best first for every vector: of a vector's open nodes the one with the least
bound comes next, and the search ends when that bound lies beyond the best distance so
far. The vectors of a batch take such steps together, grouped by the node they are
at. A node on the radius itself is still opened (the radius is inclusive, and bounds are
taken a little lower than computed), so that ties reach the smaller centroid number.

Distances are squared and exact: sums in longs while none can overflow, else in
Python's integers. Each task adds up its own vectors per centroid; these sums are
added by an aggregate, and ``k * dim`` of them reach the driver. A round reads the
written vectors and nothing else, so a lost executor costs the tasks it had.

Results for the odd cases: vectors that are NULL, of another length, or that hold NULL or
non-finite components take no part, so that an empty table gives an empty result. Rows are
vectors one by one, also if they repeat an id; rows without an id are assigned like
others but start no centroid before all rows with one. Equal hashes at the start go by
the components. With fewer vectors than centroids every vector starts one. A centroid
without vectors stays where it is. A distance beyond a long, or a sum beyond 38 digits, is
an error. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmill.llm.tables import kept

SCALE = 256
CENTROIDS = 40
ROUNDS = 5
DIM = 64
SEED = 2
#: Centroids in a leaf of the tree.
LEAF = 4
#: The most numbers a broadcast set of centroids may hold (64 MB).
MAX_NUMBERS = 1 << 23
_LONG = 1 << 62


# --- the tree -------------------------------------------------------------------


@dataclass
class Node:
    """A leaf's centroid numbers, or a vantage point and its children with the distances they span."""

    members: np.ndarray
    children: list[tuple[int, float, float]] = field(default_factory=list)


class Tree:
    """A vantage-point tree over the rows of ``centroids`` (whole numbers, of type object if they are large)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[Node] = []
        if len(centroids):
            self._add(np.arange(len(centroids)))

    def _add(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members))
        if len(members) <= LEAF:
            return at
        point, rest = members[0], members[1:]
        away = np.sqrt(squared(self.centroids[rest], self.centroids[[point]])[:, 0].astype(np.float64))
        order = np.argsort(away, kind="stable")
        self.nodes[at].members = members[:1]
        for half in np.array_split(order, 2):
            child = self._add(rest[half])
            self.nodes[at].children.append((child, float(away[half].min()), float(away[half].max())))
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of every row of ``x`` and its squared distance; ties to the smaller number."""
        n = len(x)
        far = np.iinfo(np.int64).max if self.centroids.dtype != object else 1 << 4096
        found, distance = np.full(n, len(self.centroids)), np.full(n, far, self.centroids.dtype)
        if not n or not self.nodes:
            return found, distance
        radius = np.full(n, np.inf)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(n)
        while True:
            node = bound[active].argmin(1)
            least = bound[active, node]
            more = np.isfinite(least) & (least <= radius[active])
            active, node, least = active[more], node[more], least[more]
            if not len(active):
                return found, distance
            bound[active, node] = np.inf
            for at in np.unique(node):
                here = node == at
                rows, below = active[here], least[here]
                part = self.nodes[at]
                d = squared(x[rows], self.centroids[part.members])
                best = d.min(1)
                number = np.where(d == best[:, None], part.members, len(self.centroids)).min(1)
                nearer = (best < distance[rows]) | ((best == distance[rows]) & (number < found[rows]))
                won = rows[nearer]
                found[won], distance[won] = number[nearer], best[nearer]
                radius[won] = np.sqrt(best[nearer].astype(np.float64))
                away = np.sqrt(d[:, 0].astype(np.float64))
                for child, low, high in part.children:
                    reach = np.maximum(away - high, low - away)
                    bound[rows, child] = np.maximum(below, reach - 1e-9 * (away + high) - 1e-9)


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every point."""
    if x.dtype == object:
        return np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, p)) for p in points] for v in x], object).reshape(len(x), len(points))
    out = np.empty((len(x), len(points)), np.int64)
    for i, p in enumerate(points):
        away = x - p
        out[:, i] = np.einsum("nd,nd->n", away, away)
    return out


def whole(x: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Whole doubles as longs, or as Python's integers if squared distances might pass a long."""
    most = max([float(np.abs(v).max(initial=0)) for v in (x, *others)])
    if (2 * most) ** 2 * max(x.shape[-1], 1) < _LONG:
        return x.astype(np.int64)
    return np.array([[int(a) for a in v] for v in x], object).reshape(x.shape)


# --- the rounds -----------------------------------------------------------------


def usable(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: rows that take part, components times ``scale``, as doubles."""
    x = F.col(column).cast("array<double>")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dim) & ~bad)
    # floors are taken in the tasks: SQL's floor() gives a long, which a large component would pass
    return rows.select("vec_id", F.transform("x", lambda v: v * float(scale)).alias("x"))


def starts(rows: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[float]]:
    """The vectors with the smallest keyed hashes of their ids, at most ``k``."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(h.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return [r["x"] for r in first]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim))


def _prepared(tree: Tree, x: np.ndarray) -> tuple[Tree, np.ndarray]:
    """Tree and vectors in one type of number."""
    if tree.centroids.dtype != object:
        y = whole(x, tree.centroids)
        return (tree, y) if y.dtype != object else (Tree(tree.centroids.astype(object)), y)
    return tree, np.array([[int(a) for a in v] for v in x], object).reshape(x.shape)


def _tree(centroids: list[list[int]], dim: int) -> Tree:
    if len(centroids) * dim > MAX_NUMBERS:
        raise ValueError(f"{len(centroids)} centroids of {dim} components are too many to broadcast")
    exact = np.array(centroids, object).reshape(len(centroids), dim)
    most = max((abs(v) for v in exact.ravel()), default=0)
    return Tree(exact.astype(np.int64) if (2 * most) ** 2 * max(dim, 1) < _LONG else exact)


def moved(rows: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after one round: floors of the means of the vectors nearest to each."""
    shared = rows.sparkSession.sparkContext.broadcast(_tree(centroids, dim))

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for b in batches:
            tree, x = _prepared(shared.value, _matrix(b.column(0), dim))
            of, _ = tree.nearest(x)
            for c in np.unique(of):
                mine = x[of == c].astype(np.int64 if x.dtype != object else object).sum(0).astype(object)
                sums[c] = sums.get(c, 0) + mine
                counts[c] = counts.get(c, 0) + int((of == c).sum())
        for c, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(c)], pa.int32()), pa.array([counts[c]], pa.int64()),
                 pa.array([[Decimal(int(v)) for v in total]], pa.list_(pa.decimal128(38, 0)))], ["c", "n", "sums"])

    parts = rows.select("x").mapInArrow(run, "c int, n long, sums array<decimal(38,0)>")
    added = parts.select("c", "n", F.posexplode("sums").alias("i", "v")).groupBy("c", "i").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).collect()  # k * dim rows
    shared.unpersist()
    out = [list(c) for c in centroids]
    for r in added:
        out[r["c"]][r["i"]] = int(r["v"]) // r["n"]
    return out


def assigned(rows: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """``(vec_id, cluster, distance)`` for every vector."""
    shared = rows.sparkSession.sparkContext.broadcast(_tree(centroids, dim))

    def run(batches):
        for b in batches:
            tree, x = _prepared(shared.value, _matrix(b.column(1), dim))
            of, distance = tree.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(of.astype(np.int32)), pa.array(distance.tolist(), pa.int64())], ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, cluster int, distance long")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` of the vectors that take part, written, and the final centroids."""
    rows = kept(usable(vectors, dim, scale), "centroid-vectors")
    centroids = [[int(np.floor(v)) for v in x] for x in starts(rows, k)]
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids, dim)
    return kept(assigned(rows, centroids, dim), "centroid-clusters"), centroids


def with_inertia(spark: SparkSession, found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``found`` with the inertia of each row's cluster and of all, and the digest of its centroid."""
    totals = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    about = spark.createDataFrame(
        [(c, totals[c], sum(totals.values()), digest(centroids[c])) for c in totals],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", *about.columns[:1], "distance", *about.columns[1:])
