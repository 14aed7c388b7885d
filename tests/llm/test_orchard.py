"""Op 13 against a plain k-means in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from medtable.llm import orchard

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance int, small string, n int"


def frame(spark, rows):
    """Vectors with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, v, "x", 1, "y", 2) for i, v in rows], SCHEMA)


def plain(rows, clusters=orchard.CLUSTERS, rounds=orchard.ROUNDS, seed=orchard.SEED, size=orchard.SIZE):
    """vec_id, cluster, distance of all vectors that take part, and the centroids."""
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centroids)]
    out = []
    for i, v in kept:
        d, k = nearest(v)
        out.append((i, k, d))
    return out, centroids


def checked(spark, rows):
    want, centroids = plain(rows)
    got = orchard.report(frame(spark, rows)).collect()
    long = (1 << 63) - 1
    sums = {}
    for _, k, d in want:
        sums[k] = None if d > long or sums.get(k, 0) is None else sums.get(k, 0) + d
    whole = None if None in sums.values() else sum(sums.values())

    def fits(x):
        return x if x is not None and x <= long else None
    full = [(i, k, fits(d), fits(sums[k]), fits(whole), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, k, d in want]
    key = repr
    assert sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got), key=key) == sorted(full, key=key)


def test_search_equals_all_distances():
    rng = np.random.default_rng(5)
    for k, d, spread in ((1, 3, 4), (2, 1, 2), (7, 2, 3), (40, 8, 50), (40, 64, 5)):
        centroids = rng.integers(-spread, spread + 1, (k, d))
        x = rng.integers(-spread - 2, spread + 3, (500, d))
        best, near, measured = orchard.orchard(x, centroids, *orchard.neighbour_lists(centroids))
        apart = ((x[:, None] - centroids[None]) ** 2).sum(-1)
        assert (near == apart.min(1)).all() and (best == apart.argmin(1)).all()  # argmin: the smaller number of ties
        assert measured <= len(x) * k


def test_search_measures_few_distances_of_grouped_vectors():
    rng = np.random.default_rng(6)
    centroids = rng.integers(-10_000, 10_000, (40, 16))
    x = centroids[rng.integers(0, 40, 2000)] + rng.integers(-300, 300, (2000, 16))
    _, _, measured = orchard.orchard(x, centroids, *orchard.neighbour_lists(centroids))
    assert measured < 0.75 * len(x) * 40


def test_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    checked(spark, rows)


def test_odd_rows_ties_and_huge_components(spark):
    rng = random.Random(1)
    near = [[float(rng.randrange(-2, 3)) for _ in range(64)] for _ in range(30)]
    rows = [(k, near[k % 30]) for k in range(90)] + [(5, near[5])] * 3 + [(None, near[3]), (None, near[4])]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63), (205, [math.nan] + [1.0] * 63), (206, [math.inf] * 64)]
    checked(spark, rows)
    checked(spark, rows + [(300 + k, [1e306 * (k + 1)] + [0.0] * 63) for k in range(3)] + [(310, [-1.7e308] * 64), (311, [3e5] * 64), (312, [-3e5] * 64)])


def test_fewer_vectors_than_clusters_and_empty(spark):
    checked(spark, [(k, [k / 7] * 64) for k in range(5)])
    checked(spark, [(None, [1.5] * 64)])
    empty = orchard.report(frame(spark, []))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("value", [0.1, -0.1, 1e300, -1e300, 1.7e308, 2.0 ** 53 + 2])
def test_whole_components_are_exact(value):
    from fractions import Fraction

    assert orchard.whole_components(np.array([value])) == [math.floor(256 * Fraction(value))]


def test_check_sql_agrees(spark, sf):
    from tests.check import compare, connect

    error, _ = compare(orchard.op13(spark, sf), connect(sf), orchard.check_sql())
    assert error is None
