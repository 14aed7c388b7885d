"""Op 10: approximate nearest neighbours by a robust-pruned directed graph in each shard.

Vectors of one direction are one node that keeps the rows with its smallest ids, so copies and scaled copies cost
nothing and never crowd out each other's links: by cosine they tie, and a tie goes to the smaller vec_id. Nodes are
dealt to shards of bounded size. In a shard, points join the graph in growing batches: a greedy search from the entry point
proposes neighbours, pruning with a relaxed distance keeps diverse ones, and edges back are pruned again
when a point has too many. Queries are searched in every shard by beam search, in blocks; all that a beam holds is
scored by the cosine of the original vectors in double precision, and the best of all shards are merged.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id.
Vectors of different length are never compared. Repeated rows count once. Components are scaled by powers of two before
they are squared, so very large and very small ones have finite scores. Directions are equal if all
components of their unit vectors are within 1e-12. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, grouped_rows, table, written
from .registry import query

SHARD = 4096
DEGREE, BEAM, ALPHA = 32, 96, 1.2
K, EVERY = 5, 50
QUERY_BLOCK = 2000


# ---- the graph of one shard; x has unit rows ----

def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the ``beam`` nearest points that greedy steps reach, nearest first; -1 where none."""
    m, n = len(queries), len(x)
    rows = np.arange(m)[:, None]
    ids = np.full((m, beam), -1, np.int64)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = 2 - 2 * (queries @ x[entry])
    seen[:, entry] = seen[:, n] = True
    live = np.arange(m)
    while len(live):
        open_dist = np.where(done[live], np.inf, dist[live])
        pick = np.argsort(open_dist, axis=1)[:, :width]
        ready = np.take_along_axis(open_dist, pick, 1) < np.inf
        keep = ready.any(axis=1)
        live, pick, ready = live[keep], pick[keep], ready[keep]
        if not len(live):
            break
        chosen = np.where(ready, ids[live[:, None], pick], -1)
        done[live[:, None], pick] = True
        near = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        fresh = ~seen[live[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        d = np.full(near.shape, np.inf, np.float32)
        a, b = np.nonzero(fresh)
        d[a, b] = 2 - 2 * np.einsum("ij,ij->i", x[near[a, b]], queries[live[a]])
        every = np.concatenate([dist[live], d], axis=1)
        best = np.argpartition(every, beam - 1, axis=1)[:, :beam] if every.shape[1] > beam else np.arange(every.shape[1])[None].repeat(len(live), 0)
        dist[live] = np.take_along_axis(every, best, 1)
        ids[live] = np.where(np.isfinite(dist[live]), np.take_along_axis(np.concatenate([ids[live], near], axis=1), best, 1), -1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), best, 1) | ~np.isfinite(dist[live])
    order = np.argsort(dist, axis=1)
    return ids[rows, order], dist[rows, order]


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point, up to ``degree`` of its candidates (-1: none), nearest first; a candidate goes if a kept
    one is ``alpha`` times nearer to it than the point is."""
    candidates = np.sort(np.where(candidates == points[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    vectors = x[candidates]
    to_point = (2 - 2 * np.einsum("pcd,pd->pc", vectors, x[points])).astype(np.float32)
    to_point[candidates < 0] = np.inf
    out = np.full((len(points), degree), -1, np.int64)
    left = to_point.copy()
    rows = np.arange(len(points))
    for k in range(degree):
        best = left.argmin(axis=1)
        ok = np.isfinite(left[rows, best])
        if not ok.any():
            break
        out[ok, k] = candidates[rows, best][ok]
        between = 2 - 2 * np.einsum("pcd,pd->pc", vectors, vectors[rows, best])
        left[(alpha * alpha * between <= to_point) & ok[:, None]] = np.inf
        left[rows, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Neighbours of every point and the entry point, the one nearest to the mean."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    entry = int((x @ x.mean(axis=0)).argmax())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        batch = order[at:at + min(at, 512)]
        found, _ = beam_search(x, graph, entry, x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, alpha)
        source, target = np.repeat(batch, degree), graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        place = np.argsort(target, kind="stable")
        source, target = source[place], target[place]
        heads = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        counts = np.diff(np.append(heads, len(target)))
        for few in np.array_split(np.argsort(counts, kind="stable"), max(1, len(heads) // 256)):
            if not len(few):
                continue
            points = target[heads[few]]
            extra = np.full((len(few), int(counts[few].max())), -1, np.int64)
            column = np.arange(extra.shape[1])
            inside = column < counts[few][:, None]
            extra[inside] = source[(heads[few][:, None] + column)[inside]]
            whole = np.concatenate([graph[points], extra], axis=1)
            degrees = (whole >= 0).sum(axis=1)
            full = degrees > degree
            if full.any():
                graph[points[full]] = robust_prune(x, points[full], whole[full], degree, alpha)
            if (~full).any():
                graph[points[~full]] = -np.sort(-whole[~full], axis=1)[:, :degree]
        at += len(batch)
    return graph, entry


# ---- Spark ----

def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component between 1/2 and 1; exact, and safe to square."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of every row of ``x`` with ``q``."""
    x, q = scaled(x), scaled(q[None])[0]
    return (x @ q) / (np.linalg.norm(x, axis=1) * np.linalg.norm(q))


#: Decimals of a unit vector's components that tell directions apart.
DIGITS = 12
_ROW = pa.list_(pa.struct([("vec_id", pa.int64()), ("vector", pa.binary())]))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Directions of the vectors that take part, each with the ``K + 1`` rows of smallest id that a batch has; and the queries."""
    for batch in batches:
        held: dict[bytes, dict[int, bytes]] = {}
        queries = []
        for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if vec_id is None or not values.is_valid:
                continue
            if values.values.null_count or not len(values.values):
                continue
            v = values.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            if not np.isfinite(v).all() or not v.any():
                continue
            direction = (np.round(units(v[None])[0], DIGITS) + 0.0).tobytes()
            mine = held.setdefault(direction, {})
            mine[vec_id] = min(v.tobytes(), mine.get(vec_id, v.tobytes()))
            if vec_id % EVERY == 0:
                queries.append((vec_id, v.tobytes()))
        rows = [(d, [{"vec_id": i, "vector": ids[i]} for i in sorted(ids)[:K + 1]], None, None) for d, ids in held.items()]
        rows += [(None, None, i, v) for i, v in queries]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], _ROW), pa.array([r[2] for r in rows], pa.int64()),
                                          pa.array([r[3] for r in rows], pa.binary())], ["direction", "rows", "query_id", "vector"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard: its nodes' directions, their rows and its graph."""
    for (dim, shard), rows in grouped_rows(batches, ["dim", "shard"]):
        rows.sort(key=lambda r: r["direction"])
        graph, entry = build(units(np.array([np.frombuffer(r["direction"]) for r in rows])).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([shard], pa.int32()), pa.array([entry], pa.int32()), pa.array([[r["direction"] for r in rows]], pa.list_(pa.binary())),
             pa.array([[r["rows"] for r in rows]], pa.list_(_ROW)), pa.array([graph.astype("<i4").tobytes()], pa.binary())],
            ["dim", "shard", "entry", "directions", "rows", "graph"])


def _search(left: pa.Table, right: pa.Table) -> pa.Table:
    """Beam search of a block of queries in a shard."""
    out: list[tuple[int, int, float]] = []
    if left.num_rows and right.num_rows:
        shard = left.slice(0, 1).to_pylist()[0]
        unit = units(np.array([np.frombuffer(d) for d in shard["directions"]])).astype(np.float32)
        graph = np.frombuffer(shard["graph"], "<i4").astype(np.int64).reshape(len(unit), -1)
        first = np.concatenate([[0], np.cumsum([len(r) for r in shard["rows"]])])
        ids = np.array([r["vec_id"] for rows in shard["rows"] for r in rows], np.int64)
        x = np.array([np.frombuffer(r["vector"]) for rows in shard["rows"] for r in rows])
        queries = right.column("query_id").to_pylist()
        q = np.array([np.frombuffer(v) for v in right.column("vector").to_pylist()])
        for a in range(0, len(q), 512):
            found, _ = beam_search(unit, graph, shard["entry"], units(q[a:a + 512]).astype(np.float32), BEAM)
            for k, row in enumerate(found):
                near = np.concatenate([np.arange(first[p], first[p + 1]) for p in row[row >= 0]])
                near = near[ids[near] != queries[a + k]]
                scores = cosines(x[near], q[a + k]) if len(near) else np.zeros(0)
                best = np.lexsort((ids[near], -scores))[:K]
                out.extend((queries[a + k], int(ids[near[p]]), float(scores[p])) for p in best)
    return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.float64())})


def nearest(vectors: DataFrame) -> DataFrame:
    """The ``K`` nearest rows of every row whose vec_id is divisible by ``EVERY``."""
    kind = "array<struct<vec_id:bigint,vector:binary>>"
    rows = written(arrow_map(vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")), _usable,
                             f"direction binary, rows {kind}, query_id bigint, vector binary"), "vectors")
    first = F.slice(F.array_distinct(F.sort_array(F.flatten(F.collect_list("rows")))), 1, K + 1).alias("rows")
    # a direction that many batches have is reduced in groups first
    nodes = rows.where("rows is not null").withColumn("_group", F.pmod(F.xxhash64("rows"), F.lit(64))).groupBy("direction", "_group").agg(first).groupBy("direction").agg(first)
    nodes = nodes.withColumn("dim", (F.octet_length("direction") / 8).cast("int"))
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD)).cast("int").alias("shards"))
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("direction"), F.col("shards")).cast("int")).select("dim", "shard", "direction", "rows")
    index = arrow_map(dealt.repartition("dim", "shard").sortWithinPartitions("dim", "shard"), _index,
                      f"dim int, shard int, entry int, directions array<binary>, rows array<{kind}>, graph binary")
    index = written(index, "graphs")
    asked = rows.where("query_id is not null").select("query_id", "vector").distinct().withColumn("dim", (F.octet_length("vector") / 8).cast("int"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).join(index.select(F.col("dim").alias("dim"), F.col("shard").alias("shard")), "dim")
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = shards.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


@query("op10_pruned_graph")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
