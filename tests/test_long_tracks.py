"""Tracks smoothed by blocks against tracks smoothed whole."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklake.operators import gps, long_tracks


def walk(rng, n):
    t = np.cumsum(rng.choice([0.0, 0.25, 1.0, 1.0, 1.0, 7.0, 900.0], n, p=[0.02, 0.1, 0.3, 0.3, 0.2, 0.07, 0.01]))
    z = np.array([37.8, -122.3]) + np.cumsum(rng.normal(0, 1e-4, (n, 2)), 0) + rng.normal(0, 1e-5, (n, 2))
    return t, z


@pytest.mark.parametrize("noise", [(1e-9, 1e-10), (1e-6, 1e-10), (1e-12, 1e-8)])
def test_blocks_are_the_whole(noise):
    """Blocks of any lengths, ones of one fix too, give the smoother of the whole track."""
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 50, 3000):
        t, z = walk(rng, n)
        want = gps.smooth_axis(t, z, *noise)
        cuts = sorted({0, *rng.integers(0, n, rng.integers(0, 9)).tolist()})
        bounds = list(zip(cuts, [*cuts[1:], n]))
        elements = [long_tracks.summary(t[i:j], z[i:j], *noise) for i, j in bounds]
        before, after = long_tracks.scan(np.array([t[i] for i, _ in bounds]), np.array([t[j - 1] for _, j in bounds]), np.array([z[i] for i, _ in bounds]), elements, *noise)
        got = np.concatenate([gps.smooth_axis(t[i:j], z[i:j], *noise, b, a) for (i, j), b, a in zip(bounds, before, after)])
        assert np.abs(got - want).max() < 1e-9, n


def test_elements_combine_in_any_grouping():
    rng = np.random.default_rng(3)
    t, z = walk(rng, 40)
    e = long_tracks.step_elements(np.diff(t), z[1:] - z[0], 1e-9, 1e-10)
    one = tuple(x[0] for x in e)
    for k in range(1, 39):
        one = long_tracks.combined(one, tuple(x[k] for x in e))
    for a, b in zip(one, long_tracks.reduced(e)):
        assert np.allclose(a, b, rtol=1e-6, atol=1e-12 * np.abs(a).max())


@pytest.mark.parametrize("block_s", [1.0, 60.0, 1e7])
def test_on_spark(spark, block_s):
    rng, rows = random.Random(4), []
    for g in ("a", None, "b"):
        t = 1_700_000_000
        for _ in range(300):
            t += rng.choice([1, 1, 1, 5, 200])
            rows.append((len(rows), g, t, 37.8 + rng.random() / 1e3, -122.3 + rng.random() / 1e3))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, g string, t long, lat double, lon double").withColumn("sample_time", F.timestamp_seconds("t")).repartition(5)
    found = [{r.k: (r.lat_kf, r.lon_kf) for r in f(df, ["g"]).collect()} for f in (gps.smooth, lambda d, by: long_tracks.smooth(d, by, block_s=block_s))]
    assert found[0].keys() == found[1].keys() and all(np.allclose(found[0][k], found[1][k], rtol=0, atol=1e-9) for k in found[0])
    assert long_tracks.smooth(df.limit(0), ["g"]).collect() == [] and long_tracks.smooth(df, []).count() == 900


def test_blocks_stay_whole_in_skewed_joins(spark):
    """A block that holds nearly all rows is not dealt to several tasks, whichever join Spark picks."""
    df = spark.range(0, 20_000, 1, 12).select("id", F.lit("a").alias("g"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("sample_time"), (F.sin("id") / 1000 + 37.8).alias("lat"), (F.cos("id") / 1000).alias("lon"))
    want = {r.id: (r.lat_kf, r.lon_kf) for r in gps.smooth(df, ["g"]).collect()}
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.id: (r.lat_kf, r.lon_kf) for r in long_tracks.smooth(df, ["g"], block_s=15_000).collect()}
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=0, atol=1e-9) for k in want)


def test_many_short_blocks_are_done_together(spark):
    """Blocks of one to four fixes of tracks of one to five blocks, as each by itself, and 120,000 of them in seconds."""
    rng = np.random.default_rng(12)
    noise, out = (1e-9, 1e-10), []
    for tracks in (60, 40_000):
        blocks = rng.integers(1, 6, tracks)
        size = rng.integers(1, 5, blocks.sum())
        starts, first = np.cumsum(size) - size, np.cumsum(blocks) - blocks
        t, z = np.cumsum(rng.integers(0, 9, size.sum())).astype(float), rng.normal(0, 1e-4, (size.sum(), 2)) + [37.8, -122.3]
        begun = time.monotonic()
        e = long_tracks.summaries(t, z, starts, *noise)
        before, after = long_tracks.scans(t[starts], t[starts + size - 1], z[starts], e, first, *noise)
        out.append((long_tracks.smooth_blocks(t, z, starts, before, after, *noise), time.monotonic() - begun, t, z, starts[first]))
    assert out[1][1] < 20
    for got, _, t, z, begins in out:
        bounds = list(zip(begins.tolist(), [*begins[1:].tolist(), len(t)]))[:60]
        for i, j in bounds:
            assert np.abs(got[i:j] - gps.smooth_axis(t[i:j], z[i:j], *noise)).max() < 1e-9
