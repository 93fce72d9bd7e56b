"""Segmented operators against the windows over whole groups."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracklake.operators import ordered, segmented

SCHEMA = "k long, g string, h int, t timestamp_ntz, lat double, lon double, v double, w double"


def readings(spark, seed):
    rng, rows, start = random.Random(seed), [], datetime(2025, 3, 9)
    for g in (None, "a", "b", "long"):
        t = start
        for _ in range(2000 if g == "long" else rng.randrange(1, 60)):
            t += timedelta(microseconds=rng.choice([1_000_000, 1_000_000, 30_000_000, 31_000_000, 4_000_000_000, 250_000]))
            spot = rng.choice([(None, 1.0), (1.0, 2.0), (1.0, 2.0), (1.5, 2.0), (1.0, None)])
            rows.append((len(rows), g, rng.choice([1, None]), t, *spot, rng.choice([None, None, rng.random()]), None if rng.random() < 0.999 else 1.0))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def same(a, b, *names):
    found = [{r.k: tuple(r[n] for n in names) for r in df.collect()} for df in (a, b)]
    assert found[0] == found[1]


@pytest.mark.parametrize("bucket_s", [10.0, 700.0, 1e9])
def test_as_the_windows(spark, bucket_s):
    df, by = readings(spark, int(bucket_s) % 97), ["g", "h"]
    for inclusive in (True, False):
        same(segmented.sessions(df, by, "t", 30, inclusive, ["t", "k"], bucket_s=bucket_s), ordered.sessions(df, by, "t", 30, inclusive, ["t", "k"]), "period")
    same(segmented.passes(df, by, ["t", "k"], "lat", "lon", bucket_s=bucket_s), ordered.passes(df, by, ["t", "k"], "lat", "lon"), "drive_pass")
    whole = segmented.fill_gaps(df, by, "t", ["v", "w"], 40.0, bucket_s=bucket_s)
    same(whole, ordered.fill_gaps(df, by, "t", ["v", "w"], 40.0), "v", "w")
    assert sorted(whole.columns) == sorted(df.columns)
    assert segmented.sessions(df.limit(0), by, "t", 30, True).collect() == []


def test_rows_without_a_time(spark):
    rows = [(k, "a", 1, None if k < 3 else datetime(2025, 1, 1, 0, 0, k), None, None, 1.0, None) for k in range(8)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(segmented.sessions(df, ["g"], "t", 1.5, True, ["t", "k"], bucket_s=2.0), ordered.sessions(df, ["g"], "t", 1.5, True, ["t", "k"]), "period")


def test_a_group_lies_in_many_tasks(spark):
    """One key: no task holds more than a few of its buckets."""
    rows = spark.range(200_000).select(F.lit(1).alias("g"), F.timestamp_seconds(F.col("id") + F.floor(F.col("id") / 5000) * 60).alias("t"))
    out = segmented.sessions(rows, ["g"], "t", 30, True, bucket_s=600)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 200_000 and out.agg(F.max("period")).first()[0] == 40
