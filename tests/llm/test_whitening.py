"""Whitening against plain numpy over all rows."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pricevault.llm.q_whitening import op13_embedding_whitening
from pricevault.llm.whitening import bit_planes, cross_products, whiten

KIND = "vec_id long, embedding array<float>"


def plain(vectors, components=32):
    dims = max(map(len, vectors))
    c = np.array([[*map(float, v), *[0.0] * (dims - len(v))] for v in vectors])
    x = np.floor(64 * c).astype(object).astype(int) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float(Fraction(n * int(a) - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviation, centred @ axes / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(cov)


def check(rows, vectors, whitened_all=True):
    n, deviation, whitened, explained = plain(vectors)
    count = len(explained)
    by_row = sorted(rows, key=lambda r: (r.vec_id, r.component))
    assert len(by_row) == n * count
    for i in range(n):
        mine = by_row[i * count : (i + 1) * count]
        assert [r.component for r in mine] == list(range(1, count + 1))
        assert {(r.n, int(r.deviation)) for r in mine} == {(n, deviation[i])}
        np.testing.assert_allclose([r.explained for r in mine], explained, rtol=1e-5)
    if whitened_all:
        got = np.array([r.whitened for r in by_row]).reshape(n, count)
        for k in range(count):
            sign = np.sign(got[:, k] @ whitened[:, k])
            np.testing.assert_allclose(got[:, k] * sign, whitened[:, k], atol=1e-7)
        cov = got.T @ got / n
        assert abs(cov - np.eye(count)).max() <= 1e-4
        assert abs(by_row[0].identity_error) <= 1e-4 and len({r.identity_error for r in by_row}) == 1


def test_bit_planes_hold_the_values():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 1000, (130, 5))
    y[:, 2] = 0
    words, owner, power = bit_planes(y)
    back = np.zeros_like(y)
    for w, d, p in zip(words, owner, power, strict=True):
        back[:, d] += np.unpackbits(w.view(np.uint8), bitorder="little")[:130].astype(np.int64) << int(p)
    assert (back == y).all()


@pytest.mark.parametrize(("rows", "dims", "most"), [(1, 3, 9), (64, 1, 1), (200, 6, 2**40), (777, 20, 180), (5, 4, 1)])
def test_cross_products_are_exact(rows, dims, most):
    y = np.random.default_rng(rows).integers(0, most, (rows, dims))
    wide = y.astype(object)
    assert cross_products(y) == (wide.T @ wide).tolist()


def test_given_embeddings(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = [r.embedding for r in given if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    rows = op13_embedding_whitening(spark, sf_dir)
    assert dict(rows.dtypes)["deviation"] == "bigint"
    check(rows.collect(), vectors)


def test_unusable_vectors_are_dropped_and_many_partitions_add_up(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=4).tolist() for _ in range(300)] + [[2.0, 2.0, 2.0, 2.0]] * 150  # repeated rows
    bad = [None, [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(bad)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, component string, n int").repartition(9)
    check(whiten(frame).collect(), vectors)


def test_outliers_and_shorter_vectors(spark):
    rng = np.random.default_rng(6)
    vectors = [rng.normal(size=3).tolist() for _ in range(60)] + [[1e5, -1e4, 0.5], [1.0, 2.0], [3.0]]
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    check(whiten(frame).collect(), vectors, whitened_all=False)


def test_components_without_spread_are_null(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (None, [3.0, 2.0])], KIND)
    rows = whiten(frame).collect()
    assert len(rows) == 6 and {r.vec_id for r in rows} == {1, 2, None}
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in rows)
    same = whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0])], KIND)).collect()
    assert [(r.whitened, r.explained, int(r.deviation)) for r in same] == [(None, 0.0, 0)] * 2


def test_no_usable_vector(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [float("nan")])]):
        assert whiten(spark.createDataFrame(rows, KIND)).collect() == []


def test_an_entry_beyond_the_range_stops(spark):
    with pytest.raises(Exception, match="beyond the range"):
        whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()
