"""Op 13: k-means on integer vectors; every assignment is an Orchard search.

Each centroid has a list of the others, nearest first. A vector starts at centroid 0 and walks that list; as soon as
a nearer centroid turns up, the walk goes on in that one's list. Centroids met once are marked and not measured
again. A list is left when its next entry is strictly further from the list's owner than twice the distance
reached, as no later entry can be as near as the owner: the triangle inequality. At exactly twice the distance an
entry may still tie, and ties go to the smaller number.

All sums are exact. Components are ``floor(256 * x)``; squared distances fit 64 bits while no component is beyond
``SAFE``; vectors beyond that are worked off in Python integers. A distance that no long can hold
is null, as are the inertias it is part of. The centroids, at most ``CLUSTERS`` rows, are all that comes to the driver.

Vectors of another length, null ones and those with a null or non-finite component take no part. Repeated rows are
vectors of their own. Rows without a vec_id are clustered like others, but become a centroid only where
there are fewer than ``CLUSTERS`` rows with one. Among equal hashes the smaller vector comes first, those beyond ``SAFE`` last. Fewer
vectors than clusters give as many centroids as there are vectors; no vector gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table, written
from .registry import query

SIZE, CLUSTERS, ROUNDS, SEED = 64, 40, 5, 2
#: Components below this have squared distances of which four fit 64 bits, with ``SIZE`` components.
SAFE = 1 << 26
_LONG = (1 << 63) - 1
#: Vectors that one step of the walk works on.
BLOCK = 8192


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all others, nearest first, and their squared distances from it."""
    apart = squared(centroids[:, None, :] - centroids[None, :, :])
    order = np.array([sorted(range(len(centroids)), key=lambda j: (j != i, row[j], j)) for i, row in enumerate(apart.tolist())], np.int64).reshape(len(centroids), -1)
    lists = order[:, 1:]
    return lists, np.take_along_axis(apart, lists, 1)


def squared(difference: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", difference, difference) if difference.dtype != object else (difference * difference).sum(axis=-1)


def orchard(x: np.ndarray, centroids: np.ndarray, lists: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every row of ``x`` (ties: smaller number), the squared distance, and how many distances were measured."""
    n, k = len(x), len(centroids)
    here = np.zeros(n, np.int64)                    # whose list is walked
    near = squared(x - centroids[0]) if n else np.zeros(0, x.dtype)  # its distance
    best = here.copy()                              # of equal distances the smaller number
    place = np.zeros(n, np.int64)
    met = np.zeros((n, k), bool)
    met[:, 0] = True
    live, measured = np.arange(n), n
    while len(live):
        live = live[place[live] < k - 1]
        # both sides squared: further than twice the distance reached
        live = live[(reach[here[live], place[live]] <= 4 * near[live]).astype(bool)]
        other = lists[here[live], place[live]]
        place[live] += 1
        fresh = ~met[live, other]
        rows, other = live[fresh], other[fresh]
        met[rows, other] = True
        measured += len(rows)
        d = squared(x[rows] - centroids[other])
        nearer, tie = (d < near[rows]).astype(bool), (d == near[rows]).astype(bool) & (other < best[rows])
        best[rows[tie]] = other[tie]
        go, to = rows[nearer], other[nearer]
        here[go], best[go], near[go], place[go] = to, to, d[nearer], 0
    return best, near, measured


def whole_components(values: np.ndarray) -> list[int]:
    """floor(256 * x) of finite doubles, exactly."""
    return [math.floor(v * 256) if abs(v) < 1e300 else int(v) * 256 for v in values.tolist()]


def _kept(size: int):
    safe = math.isqrt(SAFE * SAFE * SIZE // max(size, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors that take part; as longs, or as decimal text where they are beyond ``SAFE``."""
        for batch in batches:
            ids, small, large = [], [], []
            for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                if not values.is_valid or len(values.values) != size or values.values.null_count:
                    continue
                v = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    continue
                ids.append(vec_id)
                fits = (np.abs(v) < safe // 256).all()
                small.append(np.floor(v * 256).astype(np.int64) if fits else None)
                large.append(None if fits else ",".join(map(str, whole_components(v))))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(small, pa.list_(pa.int64())), pa.array(large, pa.string())], ["vec_id", "small", "large"])
    return run


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of a batch: those of 64 bits, then those of Python integers."""
    small, large = batch.column("small"), batch.column("large")
    valid = np.flatnonzero(small.is_valid().to_numpy(zero_copy_only=False))
    for a in range(0, len(valid), BLOCK):
        rows = valid[a:a + BLOCK]
        flat = small.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.reshape(len(rows), -1)
    texts = np.flatnonzero(large.is_valid().to_numpy(zero_copy_only=False))
    for a in range(0, len(texts), 256):
        rows = texts[a:a + 256]
        yield rows, np.array([[int(c) for c in large[int(r)].as_py().split(",")] for r in rows], object)


class _Search:
    """Orchard search among fixed centroids; Python integers only for what 64 bits can't hold."""

    def __init__(self, centroids: list[list[int]]):
        exact = np.array(centroids, object).reshape(len(centroids), -1)
        safe = math.isqrt(SAFE * SAFE * SIZE // max(exact.shape[1], 1))
        self.fits = bool((abs(exact) <= safe).all())
        self.centroids = {object: exact, np.int64: exact.astype(np.int64) if self.fits else exact}
        self.lists: dict = {}

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = np.int64 if self.fits and x.dtype != object else object
        if kind not in self.lists:
            self.lists[kind] = neighbour_lists(self.centroids[kind])
        return orchard(x.astype(kind, copy=False), self.centroids[kind], *self.lists[kind])[:2]


def _sums(centroids: list[list[int]]):
    """For each centroid that got vectors: their number and the sum of their components, as decimal text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k = _Search(centroids), len(centroids)
        counts = np.zeros(k, np.int64)
        sums = np.zeros((k, len(centroids[0])), object)
        for batch in batches:
            for _, x in _blocks(batch):
                best, _ = search(x)
                for c in np.unique(best):
                    mine = x[best == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(axis=0).astype(object)
        got = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(counts[got]), pa.array([",".join(map(str, sums[c])) for c in got], pa.string())], ["cluster", "n", "sums"])
    return run


def _add(left: pa.Table) -> pa.Table:
    """Sums of one centroid from those of a group of tasks, in integers of any length."""
    rows = [[int(v) for v in t.split(",")] for t in left.column("sums").to_pylist()]
    total = [sum(c) for c in zip(*rows)]
    return pa.table({"cluster": left.column("cluster")[:1], "n": pa.array([sum(left.column("n").to_pylist())], pa.int64()), "sums": pa.array([",".join(map(str, total))])})


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; one without vectors stays."""
    schema = "cluster int, n bigint, sums string"
    parts = arrow_map(vectors, _sums(centroids), schema)
    # the sums of a centroid are added in groups of tasks first, so that no task adds those of all tasks
    parts = parts.withColumn("_group", F.pmod(F.xxhash64("sums"), F.lit(64)))
    parts = parts.groupBy("cluster", "_group").applyInArrow(lambda t: _add(t.select(["cluster", "n", "sums"])), schema)
    out = list(centroids)
    for row in parts.groupBy("cluster").applyInArrow(_add, schema).collect():  # at most one row for each centroid
        out[row["cluster"]] = [int(v) // row["n"] for v in row["sums"].split(",")]
    return out


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(centroids)
        for batch in batches:
            cluster = np.zeros(batch.num_rows, np.int32)
            distance = np.zeros(batch.num_rows, object)
            for rows, x in _blocks(batch):
                cluster[rows], distance[rows] = search(x)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array([d if d <= _LONG else None for d in distance.tolist()], pa.int64())], ["vec_id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hash of the seed and their id, in the order of the hashes."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(F.col("vec_id").isNull(), hashed, F.col("large").isNotNull(), "small", "large").limit(clusters).collect()
    return [list(r["small"]) if r["small"] is not None else [int(v) for v in r["large"].split(",")] for r in rows]


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and distance of every vector that takes part, and the final centroids."""
    source = embeddings.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    vectors = written(arrow_map(source, _kept(size), "vec_id bigint, small array<bigint>, large string"), "whole_vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        return vectors.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return written(arrow_map(vectors, _assigned(centroids), "vec_id bigint, cluster int, distance bigint"), "assigned"), centroids


def report(embeddings: DataFrame) -> DataFrame:
    """One row per vector with its cluster's and the whole inertia and a digest of its centroid."""
    spark = embeddings.sparkSession
    rows, centroids = cluster(embeddings)
    wide = F.col("distance").cast("decimal(38,0)")
    # one row for each centroid; a sum with an unknown part, or beyond a long, is unknown
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.when(F.count(F.lit(1)) == F.count("distance"), F.sum(wide)).alias("s")).collect()}
    whole = None if None in sums.values() else sum(map(int, sums.values()))

    def long(value) -> int | None:
        return int(value) if value is not None and value <= _LONG else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = [(c, long(s), long(whole), digests[c]) for c, s in sums.items()]
    stats = spark.createDataFrame(each, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def check_sql(rounds: int = ROUNDS, clusters: int = CLUSTERS, size: int = SIZE, seed: int = SEED) -> str:
    """The same in SQL: each round measures every vector against every centroid."""
    parts = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
        WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < {clusters})"""]

    def nearest(k: int) -> str:
        apart = "list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return f"""a{k} AS (SELECT row, any_value(vec_id) AS vec_id, any_value(v.x) AS x, min(struct_pack(d := CAST({apart} AS BIGINT), c := m.c)) AS b FROM v, c{k} m GROUP BY row)"""
    for k in range(rounds):
        parts.append(nearest(k))
        parts.append(f"""s{k} AS (SELECT c, i, CAST(sum(y) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM (SELECT b.c AS c, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY c, i),
      m{k} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY c),
      c{k + 1} AS (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{k} o LEFT JOIN m{k} m ON o.c = m.c)""")
    parts.append(nearest(rounds))
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, b.d AS distance, CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(m.x, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} m ON m.c = b.c"""


@query("op13_orchard_kmeans", check_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "embeddings"))
