"""Tree search against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pricevault.llm.kmeans_tree import Settings, nearest_neighbours
from pyspark.sql import functions as F

KIND = "vec_id long, embedding array<float>, score int"


def brute(ids, vectors, k=20):
    found = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = np.zeros(len(ids))
        for j in range(vectors.shape[1]):
            scores += vectors[i, j] * vectors[:, j]
        scores[i] = -np.inf
        order = np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]
        found[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def searched(frame, **kw):
    found: dict = {}
    for r in nearest_neighbours(frame, F.col("vec_id") % 20 == 0, settings=Settings(**kw)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, truth):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in near}) / len(near) for q, near in truth.items()])


def test_given_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.collect()
    truth = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float))
    found = searched(table)
    assert found.keys() == truth.keys() and all(len(found[q]) == 20 for q in truth)
    assert recall(found, truth) >= 0.9


def test_full_recall_is_exact_with_copies_and_unequal_lengths(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 8)).astype(np.float32) * rng.uniform(0.1, 3, (3000, 1)).astype(np.float32)
    vectors[500:1500] = vectors[3]  # a hot group of copies
    ids = rng.permutation(3000)
    frame = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, vectors, strict=True)], KIND)
    found = searched(frame, recall=1.0, probes=10**6, block=100)
    assert found == {q: [(i, pytest.approx(s, abs=1e-12)) for i, s in near] for q, near in brute(ids, vectors.astype(float)).items()}


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (20, [0.5, 0.5], 0), (40, None, 0), (60, [0.0, 0.0], 0), (80, [1.0, None], 0)]
    rows += [(100, [nan, 1.0], 0), (120, [inf, 1.0], 0), (140, [1.0], 0), (None, [1.0, 1.0], 0), (160, [], 0)]
    found = searched(spark.createDataFrame(rows, KIND))
    assert found == {0: [(1, 4.0), (20, 1.5)], 20: [(0, 1.5), (1, 1.5)]}
    assert searched(spark.createDataFrame([], KIND)) == {}
    assert searched(spark.createDataFrame([(20, [1.0], 0)], KIND)) == {}
