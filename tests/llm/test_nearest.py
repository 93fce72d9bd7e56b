"""Nearest neighbours: recall against brute force and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from tracklake.llm import nearest as module
from tracklake.llm.nearest import nearest
from tracklake.llm.queries import op8_collision_counting

SF = "/root/testdata/sf0.1"


def brute(ids, v, queries, k):
    out = {}
    for i in queries:
        at = np.flatnonzero(ids == i)[0]
        d = np.sqrt(np.square(v - v[at]).sum(axis=1))
        order = np.lexsort((ids, d))
        out[i] = [(ids[j], d[j]) for j in order if ids[j] != i][:k]
    return out


def test_recall_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 700 * 64)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, v = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(np.float64)
    want = brute(ids, v, ids[ids % 100 == 0], 10)
    got = {}
    for r in op8_collision_counting(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(want)
    exact = {i: dict(zip(ids, np.sqrt(np.square(v - v[ids == i]).sum(axis=1)))) for i in want}
    hit = 0
    for i, pairs in got.items():
        assert len(pairs) == 10 and pairs == sorted(pairs, key=lambda p: (p[1], p[0]))
        assert all(abs(exact[i][j] - d) < 1e-12 for j, d in pairs)
        hit += len({j for j, _ in pairs} & {j for j, _ in want[i]})
    assert hit / (10 * len(want)) >= 0.95


def test_edge_cases(spark):
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, [0.0, 3.0]), (300, None), (2, [1.0, 0.5])]
    df = spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id long, embedding array<double>, rank string, score double")
    got = [tuple(r) for r in nearest(df, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert [(q, r, i) for q, r, i, _ in got] == [(100, 1, 1), (100, 2, 2), (100, 3, 2), (200, 1, 2), (200, 2, 1), (200, 3, 2)]
    assert got[0][3] == 0.0 and got[2][3] == 0.5
    assert nearest(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_extreme_vectors(spark):
    """Finite numbers near the ends of a double's range neither loop nor hide neighbours."""
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 8))
    v[50], v[51], v[52], v[53] = 1e308, -1e308, 1e308, 1e-308
    v[52, ::2] *= -1
    v[54:60] *= 1e-200
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.lit(True), k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for i in range(60):
        want = sorted((float(module.distances(v[j : j + 1], v[i])[0]), j) for j in range(60) if j != i)[:5]
        assert [(d, j) for j, d in got[i]] == want
    assert 0 < got[54][0][1] < 1e-198


def test_many_copies_of_a_vector_and_several_lengths(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 100 * 6)
    rng = np.random.default_rng(3)
    hot = rng.normal(size=6).round(3)
    rows = [(i, (hot if i % 3 == 0 else rng.normal(size=6)).tolist()) for i in range(1500)] + [(2000 + i, rng.normal(size=2 + i % 12).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hit = total = 0
    for i, x in rows:
        if i % 50 == 0:
            near = sorted((float(module.distances(np.array([y]), np.array(x))[0]), j) for j, y in rows if j != i and len(y) == len(x))[:4]
            if i % 3 == 0 and i < 2000:
                assert got[i] == [j for _, j in near]
            hit, total = hit + len({j for _, j in near} & set(got.get(i, []))), total + len(near)
    assert hit / total > 0.95


def test_odd_names(spark):
    df = spark.createDataFrame([(100, [1.0, 2.0], "x", "y"), (1, [1.0, 2.5], "x", "y")], "`vec.id` long, `emb`` x` array<float>, v string, salt string")
    got = nearest(df, F.col("`vec.id`") % 100 == 0, id_col="vec.id", vector_col="emb` x").collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 0.5)]
