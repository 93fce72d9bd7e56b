"""Ordered operators for groups of any length: within buckets of time, then over a summary of each.

The operators of ``ordered`` look at a group's rows in one window, so a group
must fit a task.  These give the same rows with a group spread over many tasks:
rows are dealt by group and bucket of time and worked on there; each bucket is
summed up in one row; a scan over the group's summaries says what a bucket
carries in from those before (and after) it, and its rows are completed.  Rows
are shuffled once, summaries, a row for each bucket, twice more.  A group's
summaries are one window, so buckets should hold many rows: an hour of a
reading a second makes 8760 summaries a year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.clock import micros, seconds_between

#: Seconds of a bucket.
BUCKET_S = 3600.0


def _dealt(df: DataFrame, by: list[str], time: str, bucket_s: float) -> DataFrame:
    """Rows with ``_g``, their group and bucket as one value, in which nulls are values."""
    bucket = F.floor(micros(time) / F.lit(int(bucket_s * 1_000_000))).cast("long")
    return df.withColumn("_g", F.struct(*(F.col(c) for c in by), bucket.alias("_bucket")))


def _inside(order: list[str], back: bool = False):
    return Window.partitionBy("_g").orderBy(*(F.desc(c) if back else F.asc(c) for c in order))


def _over(by: list[str]):
    """Summaries of a group in the order of their buckets; rows without a time come first."""
    return Window.partitionBy(*(F.col(f"_g.{c}") for c in by)).orderBy(F.col("_g._bucket"))


def _ends(order: list[str], value: Column) -> dict[str, Column]:
    """A value in a bucket's first and last row, as a struct, so that nulls are values."""
    at, held = F.struct(*(F.col(c).isNotNull().alias(f"_n{k}") for k, c in enumerate(order)), *order), F.struct(value.alias("v"))
    return {"_first": F.min_by(held, at), "_last": F.max_by(held, at)}


def _counted(rows: DataFrame, by: list[str], order: list[str], value: Column, starts, name: str) -> DataFrame:
    """Number rows by how many start something up to them; ``starts(value, value before it or null, whether there is one)``."""
    before = F.lag(F.struct(value.alias("v"))).over(_inside(order))
    held = rows.withColumns({"_v": value, "_before": before})
    held = held.withColumn("_new", F.when(F.col("_before").isNull(), F.lit(False)).otherwise(F.coalesce(starts(F.col("_v"), F.col("_before.v"), F.lit(True)), F.lit(False))).cast("long"))
    local = held.withColumn("_c", F.sum("_new").over(_inside(order).rowsBetween(Window.unboundedPreceding, 0)))
    sums = local.groupBy("_g").agg(F.sum("_new").alias("_sum"), *(c.alias(k) for k, c in _ends(order, F.col("_v")).items()))
    last = F.lag("_last").over(_over(by))
    sums = sums.withColumn("_in", last).withColumn("_opens", F.coalesce(starts(F.col("_first.v"), F.col("_in.v"), F.col("_in").isNotNull()), F.lit(False)).cast("long"))
    base = F.sum(F.col("_opens") + F.col("_sum")).over(_over(by).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")
    carried = sums.select("_g", base.alias("_base"))
    return local.join(carried, "_g").withColumn(name, F.col("_base") + F.col("_c")).drop("_g", "_v", "_before", "_new", "_c", "_base")


def sessions(df: DataFrame, by: list[str], time: str, gap_s: float, inclusive: bool, order: list[str] | None = None, name: str = "period", bucket_s: float = BUCKET_S) -> DataFrame:
    """``ordered.sessions`` over groups of any length; ``order`` begins with ``time`` and has no ties."""
    order = order or [time]
    if order[0] != time:
        raise ValueError("rows are in the order of time first")

    def starts(now: Column, before: Column, some: Column) -> Column:
        gap = seconds_between(before, now)
        return ~some | gap.isNull() | ((gap >= gap_s) if inclusive else (gap > gap_s))

    return _counted(_dealt(df, by, time, bucket_s), by, order, F.col(time), starts, name)


def passes(df: DataFrame, by: list[str], order: list[str], lat: str, lon: str, places: int = 6, name: str = "drive_pass", bucket_s: float = BUCKET_S) -> DataFrame:
    """``ordered.passes`` over groups of any length; ``order`` begins with a time and has no ties."""
    a, b = (F.rint(F.col(c) * float(10**places)) for c in (lat, lon))
    key = F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b")))
    starts = lambda now, before, some: now.isNotNull() & (~some | ~now.eqNullSafe(before))
    counted = _counted(_dealt(df, by, order[0], bucket_s), by, order, key, starts, name)
    return counted.withColumn(name, F.when(a.isNotNull() & b.isNotNull(), F.col(name)))


def fill_gaps(df: DataFrame, by: list[str], time: str, values: list[str], limit_s: float, bucket_s: float = BUCKET_S) -> DataFrame:
    """``ordered.fill_gaps`` over groups of any length: anchors come from the bucket, else from the nearest one that has any."""
    t, rows = micros(time), _dealt(df, by, time, bucket_s)
    known = {v: F.when(F.col(v).isNotNull(), F.struct(t.alias("t"), F.col(v).cast("double").alias("v"))) for v in values}
    back, ahead = (_inside([time], b).rowsBetween(Window.unboundedPreceding, 0) for b in (False, True))
    local = rows.withColumns({f"_{k}_{v}": F.last(known[v], True).over(w) for v in values for k, w in (("p", back), ("n", ahead))})
    sums = rows.groupBy("_g").agg(*(f(known[v]).alias(f"{k}_{v}") for v in values for k, f in (("last", F.max), ("first", F.min))))
    before, after = _over(by).rowsBetween(Window.unboundedPreceding, -1), _over(by).rowsBetween(1, Window.unboundedFollowing)
    carried = sums.select("_g", *(F.last(f"last_{v}", True).over(before).alias(f"_q_{v}") for v in values), *(F.first(f"first_{v}", True).over(after).alias(f"_m_{v}") for v in values))
    joined = local.join(carried, "_g")
    new = {}
    for v in values:
        p, n = F.coalesce(f"_p_{v}", f"_q_{v}"), F.coalesce(f"_n_{v}", f"_m_{v}")
        line = p["v"] + (n["v"] - p["v"]) * ((t - p["t"]).cast("double") / (n["t"] - p["t"]).cast("double"))
        new[v] = (
            F.when(F.col(v).isNotNull(), F.col(v).cast("double"))
            .when(p.isNull() | ((t - p["t"]) / F.lit(1e6) > limit_s), F.lit(None).cast("double"))
            .when(n.isNull(), p["v"])
            .otherwise(line)
        )
    return joined.withColumns(new).drop("_g", *(f"_{k}_{v}" for v in values for k in "pnqm"))
