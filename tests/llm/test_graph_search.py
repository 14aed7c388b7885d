"""Op 10: very large and small components, scaled copies, near copies, several shards, extra columns."""

import collections

import numpy as np
import pytest

from medtable.llm import ann

SCHEMA = "vec_id bigint, embedding array<double>, direction string, shard int, query_id string, score double, rows int"


def found(spark, rows):
    out = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame([(i, v, "x", 1, "y", 2.0, 3) for i, v in rows], SCHEMA)).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    return out


def exact(x, q, k=ann.K):
    """The k best scores of row ``q`` and the ids that reach each, by cosines of scaled rows."""
    y = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    scores = y @ y[q]
    scores[q] = -2
    return np.sort(scores)[::-1][:k], scores


def recall(x, got):
    hits = total = 0
    for q in range(0, len(x), ann.EVERY):
        best, scores = exact(x, q)
        total += len(best)
        assert all(i != q and s == pytest.approx(scores[i], abs=1e-9) for i, s in got[q])
        hits += sum(scores[i] >= best[-1] - 1e-9 for i, _ in got[q])
    return hits / total


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e300])
def test_components_of_any_size(spark, size):
    x = np.random.default_rng(1).normal(size=(60, 8)) * size
    got = found(spark, list(enumerate(x.tolist())))
    assert recall(x, got) == 1.0 and all(np.isfinite(s) for rows in got.values() for _, s in rows)
    assert [i for i, _ in got[0]] == list(np.argsort(-exact(x, 0)[1], kind="stable")[:5])


@pytest.mark.parametrize("factor", [2.0, 3.7])
def test_scaled_copies(spark, factor, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 20)
    base = np.random.default_rng(2).normal(size=(50, 16))
    x = np.concatenate([base * factor ** (k % 40 - 20) for k in range(40)])
    assert recall(x, found(spark, list(enumerate(x.tolist())))) >= 0.9


def test_near_copies_and_clusters_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 500)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 3000)] + 0.2 * rng.normal(size=(3000, 24))
    x[2000:2400] = x[7] + 1e-7 * rng.normal(size=(400, 24))
    x[2400:2800] = x[7]
    assert recall(x, found(spark, list(enumerate(x.tolist())))) >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    rows = [(k, [1.0, 2.0]) for k in (400, 350, 300, 7, 9, 11, 50, 3)] + [(60, [2.0, 4.0]), (1, [2.0, 1.0])]
    got = found(spark, rows)
    assert [i for i, _ in got[50]] == [3, 7, 9, 11, 60]
    assert [i for i, _ in got[300]] == [3, 7, 9, 11, 50]
