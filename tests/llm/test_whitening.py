"""Whitened coordinates against a plain eigendecomposition of exact whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tracklake.llm.queries import QUERIES
from tracklake.llm.whitening import whiten

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("component", T.StringType()), T.StructField("x", T.StringType())])


def plain(vectors, most=32):
    """n, exact deviations, projections without sign over the scale, and shares, by the covariance of exact products."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    wide = np.array([[n * r[j] - sums[j] for j in range(d)] for r in x], dtype=object)
    cov = (wide.T @ wide).astype(float) / n**3
    values, turn = np.linalg.eigh(cov)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    return n, (wide * wide).sum(axis=1), (wide.astype(float) / n) @ turn[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


def compare(rows, ids, vectors, near=1e-7):
    n, deviation, want, share = plain(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(ids) and len(rows) == len(ids) * len(share)
    table = np.array([[got[i][c + 1].whitened for c in range(len(share))] for i in ids])
    sign = np.sign((table * want).sum(axis=0))
    assert np.abs(table * sign - want).max() < near
    for i, dev in zip(ids, deviation, strict=True):
        for c, r in got[i].items():
            assert r.n == n and r.deviation == (dev if dev < 2**63 else None)
            assert r.explained == pytest.approx(share[c - 1], rel=1e-9) and r.identity_error < 1e-9


def made(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("d,rank", [(5, 5), (40, 12), (64, 64), (120, 120)])
def test_plain_eigenvectors(spark, d, rank):
    rng = np.random.default_rng(d)
    v = (rng.standard_normal((300, rank)) * 0.7 ** np.arange(rank) * 4) @ np.linalg.qr(rng.standard_normal((d, rank)))[0].T if rank < 100 else rng.standard_normal((300, d)) * np.linspace(3, 1, d)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    compare(whiten(made(spark, rows).repartition(40)).collect(), range(300), v)


def test_low_rank_needs_no_widening(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-50, 50, (200, 6)), rng.integers(-3, 4, (6, 90))
    v = (a @ b) / 64
    compare(whiten(made(spark, [(i, r.tolist()) for i, r in enumerate(v)])).collect(), range(200), v)


def test_what_takes_no_part(spark):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((50, 4))
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [1.0, math.nan, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0])]
    rows = whiten(made(spark, [*((i, r.tolist()) for i, r in enumerate(v)), *bad])).collect()
    compare(rows, range(50), v)


def test_sums_that_a_long_cannot_hold(spark):
    v = np.array([[1e6, 0.0], [-1e6, 1.0], [3e8, -2.0], [2.0, 2.0]])
    rows = whiten(made(spark, [(i, r.tolist()) for i, r in enumerate(v)])).collect()
    compare(rows, range(4), v, near=1e-4)
    assert any(r.deviation is None for r in rows) or max(r.deviation for r in rows) > 2**60


def test_no_variance(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)]):
        assert whiten(made(spark, rows)).collect() == []


def test_repeated_and_null_ids(spark):
    v = [[0.1, 0.9], [0.5, 0.2], [0.7, 0.4], [0.7, 0.4]]
    rows = whiten(made(spark, list(zip([1, 1, None, None], v, strict=True)))).collect()
    assert sorted((str(r.vec_id), r.component) for r in rows) == sorted((i, c) for i in ("1", "1", "None", "None") for c in (1, 2))
    assert {r.n for r in rows} == {4}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op12_whitening"](spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    compare(rows, [r.vec_id for r in table], [r.embedding for r in table])
