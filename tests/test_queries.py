"""Every query with SQL against DuckDB."""

import math
import time
from pathlib import Path

import duckdb
import pytest

from tracklake import file_queries, queries, road_queries  # noqa: F401
from tracklake.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    want = duck.sql(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted((tuple(plain(r[c]) for c in cols) for r in rows), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_each_vehicles_day_is_smoothed_alone(spark, monkeypatch):
    smooth, seen = queries.gps.smooth, []
    monkeypatch.setattr(queries.gps, "smooth", lambda track, by: seen.append(by) or smooth(track, by))
    QUERIES["kalman_rts"](spark, SF)
    assert sorted(seen[0]) == ["day", "user_id"]


def test_nearly_equal_distances_keep_the_order_of_sql(spark, duck, tmp_path):
    """Segments 418 and 808 are equally far from these rows but for the last bits."""
    big = SF.replace("0.001", "0.1")
    duck.sql(f"COPY (SELECT * FROM '{big}/events.parquet' WHERE event_id % 1000 IN (409, 500, 909)) TO '{tmp_path}/events.parquet'")
    duck.sql(f"COPY (SELECT * FROM '{big}/supplier.parquet') TO '{tmp_path}/supplier.parquet'")
    other = duckdb.connect()
    for name in ("events", "supplier"):
        other.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    got = QUERIES["haversine_nearest"](spark, str(tmp_path))
    want = other.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['haversine_nearest']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_nearest_among_many_copies_of_segments(spark, tmp_path):
    """A row meets 120,000 segments in a square kilometre: all of those in its neighbourhood, row by row, were 2e9 pairs."""
    other = duckdb.connect()
    other.sql(f"COPY (SELECT i AS s_suppkey, 'S' || i AS s_name FROM range(120000) r(i)) TO '{tmp_path}/supplier.parquet'")
    start = time.monotonic()
    counts = []
    for low, high in ((0, 200_000), (1000, 1200)):
        other.sql(f"COPY (SELECT i AS event_id, i * 3 % 50 AS value FROM range({low}, {high}) r(i) UNION ALL SELECT 1100, 40 UNION ALL SELECT NULL, 40) TO '{tmp_path}/events.parquet'")
        got = QUERIES["haversine_nearest"](spark, str(tmp_path))
        counts.append(got.groupBy("match_type").count().count())
    assert time.monotonic() - start < 60 and counts == [3, 3]
    for name in ("events", "supplier"):
        other.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = other.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['haversine_nearest']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_mean_times_are_those_of_sql(spark, tmp_path):
    """Sums beyond 64 bits, and means whose fraction is near the next microsecond."""
    other = duckdb.connect()
    other.sql(f"""COPY (SELECT CAST(i % 2000 AS VARCHAR) AS o_orderpriority, make_timestamp(CASE WHEN i % 2000 < 1900 THEN 1 ELSE -1 END * CAST(1600000000000000 - hash(i) % 900000000000000 AS BIGINT)) AS o_orderdate
                  FROM range(200000) r(i) UNION ALL SELECT 'many', make_timestamp(900000000000000 + CAST(hash(i) % 86400000000 AS BIGINT)) FROM range(60001) r(i) UNION ALL SELECT 'none', NULL)
                  TO '{tmp_path}/orders.parquet'""")
    other.sql(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    got = QUERIES["timestamp_mean"](spark, str(tmp_path))
    want = other.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['timestamp_mean']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
