import hashlib
import math

import numpy as np
import pytest

from gradmill.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, x int, cluster string, distance int, c int"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 1, "a", 2, 3) for i, x in rows], SCHEMA)


def slow(rows, k, rounds, dim):
    used = [(i, [math.floor(256 * v) for v in x]) for i, x in rows
            if x is not None and len(x) == dim and all(v is not None and math.isfinite(v) for v in x)]
    keyed = sorted(used, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [list(x) for _, x in keyed[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, m)), n) for n, m in enumerate(c))

    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in used]
        for n in range(len(c)):
            mine = [x for (_, x), o in zip(used, of) if o == n]
            if mine:
                c[n] = [sum(v) // len(mine) for v in zip(*mine)]
    return sorted(((i, nearest(x)[1], nearest(x)[0]) for i, x in used), key=str), c


def got(spark, rows, **kw):
    found, final = centroids.cluster(table(spark, rows), **kw)
    return sorted((tuple(r) for r in found.collect()), key=str), final


@pytest.mark.parametrize("k", [1, 4, 40])
def test_against_plain_rounds(spark, k):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(9, 6))
    rows = [(i, (middles[i % 9] + 0.1 * rng.normal(size=6)).tolist()) for i in range(500)]
    assert got(spark, rows, k=k, dim=6) == slow(rows, k, 5, 6)


def test_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(8)  # few places, so that many distances are equal and centroids coincide
    rows = [(i % 150, (rng.integers(0, 3, 2) / 256).tolist()) for i in range(300)]
    assert got(spark, rows, k=12, dim=2) == slow(rows, 12, 5, 2)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, []), (None, [0.5, 0.5]), (7, [0.25, -0.001]),
            (8, [1.0, 2.0, 3.0]), (9, [-0.25, 0.7]), (9, [-0.25, 0.7])]
    assert got(spark, rows, k=40, dim=2) == slow(rows, 40, 5, 2)
    assert got(spark, [], k=3, dim=2) == ([], [])
    assert got(spark, rows[:6], k=3, dim=2) == ([], [])


def test_large_components_stay_exact(spark):
    rows = [(i, [float(3 + i % 4) * 1e6, float(i) / 7]) for i in range(30)]
    assert got(spark, rows, k=3, dim=2) == slow(rows, 3, 5, 2)


def test_partitions_do_not_matter(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    one, many = (centroids.cluster(table(spark, rows).repartition(n), k=7, dim=4) for n in (1, 13))
    assert one[1] == many[1] and sorted(one[0].collect()) == sorted(many[0].collect())


def test_tree_finds_the_nearest_and_prunes(monkeypatch):
    rng = np.random.default_rng(6)
    points = np.floor(1000 * rng.normal(size=(40, 3))).astype(np.int64)
    x = np.floor(1000 * rng.normal(size=(2000, 3))).astype(np.int64)
    every = ((x[:, None, :] - points[None]) ** 2).sum(2)
    looked = []
    true = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda a, b: looked.append(len(a) * len(b)) or true(a, b))
    found, distance = centroids.Tree(points).nearest(x)
    assert (found == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert sum(looked) < 0.7 * every.size


def test_inertia_and_digest(spark):
    rows = [(i, [float(i % 3), 0.5]) for i in range(30)]
    found, final = centroids.cluster(table(spark, rows), k=3, dim=2)
    out = centroids.with_inertia(spark, found, final).collect()
    for r in out:
        mine = [q.distance for q in out if q.cluster == r.cluster]
        assert (r.cluster_inertia, r.inertia) == (sum(mine), sum(q.distance for q in out))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, final[r.cluster])).encode()).hexdigest()
    empty, none = centroids.cluster(table(spark, []), k=3, dim=2)
    assert centroids.with_inertia(spark, empty, none).collect() == []


def test_size_of_the_broadcast_is_checked():
    with pytest.raises(ValueError):
        centroids._tree([[0] * (1 << 12)] * (1 << 12), 1 << 12)
