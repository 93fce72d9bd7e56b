"""Ordered operators: sessions, tails, passes, gap-limited interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.clock import mean_time, micros, seconds_between


def _window(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def since_previous(df: DataFrame, by: list[str], time: str, order: list[str] | None = None, name: str = "gap_s") -> DataFrame:
    """Seconds since the row before in the group; null for the first."""
    return df.withColumn(name, seconds_between(F.lag(time).over(_window(by, order or [time])), F.col(time)))


def running_id(df: DataFrame, by: list[str], order: list[str], starts: Column, name: str) -> DataFrame:
    """A number that grows by one at each row where ``starts`` holds."""
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(_window(by, order).rowsBetween(Window.unboundedPreceding, 0)))


def sessions(df: DataFrame, by: list[str], time: str, gap_s: float, inclusive: bool, order: list[str] | None = None, name: str = "period") -> DataFrame:
    """Number the sessions of each group from 1.

    A new one starts after a gap of ``gap_s`` or more (``inclusive``), or of
    more than it.  ``session_window`` merges rows exactly at the gap, so it
    expresses the second rule only.
    """
    order = order or [time]
    gap = seconds_between(F.lag(time).over(_window(by, order)), F.col(time))
    wide = (gap >= gap_s) if inclusive else (gap > gap_s)
    return running_id(df.withColumn("_new", gap.isNull() | wide), by, order, F.col("_new"), name).drop("_new")


def tail_rows(df: DataFrame, by: list[str], order: list[str], least: int, window: int) -> DataFrame:
    """Of each group of ``least`` rows or more: its last ``least`` rows, of these the first ``window``.

    ``order`` must be unique within the group.
    """
    if not 0 < window < least:
        raise ValueError("window must be shorter than the least number of rows")
    back = Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order))
    whole = Window.partitionBy(*by)
    ranked = df.withColumns({"_back": F.row_number().over(back), "_n": F.count("*").over(whole)})
    return ranked.filter((F.col("_n") >= least) & F.col("_back").between(least - window + 1, least)).drop("_back", "_n")


def tail_seconds(df: DataFrame, by: list[str], time: str, length_s: float, skip_s: float) -> DataFrame:
    """Of each group the rows from ``length_s + skip_s`` to ``skip_s`` seconds before its end, ends included."""
    end = F.max(time).over(Window.partitionBy(*by))
    back = seconds_between(F.col(time), F.col("_end"))
    return df.withColumn("_end", end).filter(back.between(skip_s, length_s + skip_s)).drop("_end")


def session_means(df: DataFrame, by: list[str], time: str, gap_s: float, least: int, window: int, values: list[str], order: list[str]) -> DataFrame:
    """Means over the tails of long enough sessions, with the session's number and its mean time.

    Sessions that are too short keep their number, so numbers may have holes.
    """
    numbered = sessions(df, by, time, gap_s, inclusive=False, order=order, name="flag")
    tails = tail_rows(numbered, [*by, "flag"], order, least, window)
    return tails.groupBy(*by, "flag").agg(mean_time(time).alias(time), *(F.avg(v).alias(v) for v in values))


def passes(df: DataFrame, by: list[str], order: list[str], lat: str, lon: str, places: int = 6, name: str = "drive_pass") -> DataFrame:
    """Number the passes over road segments: one more when the centre changes or follows a null.

    The count runs over the whole group, not for each segment; rows without a
    centre have none.
    """
    scale = float(10**places)
    a, b = (F.rint(F.col(c) * scale) for c in (lat, lon))
    w = _window(by, order)
    there = a.isNotNull() & b.isNotNull()
    key = F.when(there, F.struct(a.alias("a"), b.alias("b")))
    marked = df.withColumn("_key", key).withColumn("_new", F.col("_key").isNotNull() & ~F.col("_key").eqNullSafe(F.lag("_key").over(w)))
    counted = running_id(marked, by, order, F.col("_new"), name)
    return counted.withColumn(name, F.when(F.col("_key").isNotNull(), F.col(name))).drop("_key", "_new")


def densify(df: DataFrame, by: list[str], time: str, step_s: int = 1) -> DataFrame:
    """All rows of a regular grid from each group's first to its last time, joined to the rows that fall on it.

    The grid starts at the first time rounded down to the step, and ends at the
    last rounded up.
    """
    step = step_s * 1_000_000
    low, high = F.floor(F.min(micros(time)) / step) * step, F.ceil(F.max(micros(time)) / step) * step
    spine = df.filter(F.col(time).isNotNull()).groupBy(*by).agg(low.alias("_low"), high.alias("_high"))
    grid = spine.select(*by, F.explode(F.sequence("_low", "_high", F.lit(step))).alias("_us"))
    keyed = df.withColumn("_us", micros(time)).drop(time)
    return grid.join(keyed, [*by, "_us"], "left").withColumn(time, F.timestamp_micros("_us")).drop("_us")


def fill_gaps(df: DataFrame, by: list[str], time: str, values: list[str], limit_s: float) -> DataFrame:
    """Linear interpolation that reaches at most ``limit_s`` seconds past the last known value.

    Of a longer gap the first ``limit_s`` seconds are filled too.  Nulls before
    the first value stay; after the last one its value is carried on, as far as
    the limit.  Both anchors are the latest known value of a running frame,
    over the times as they rise and as they fall, so the work is linear in the
    group.
    """
    back = _window(by, [time]).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, 0)
    t = micros(time)
    out = df
    for v in values:
        at = F.when(F.col(v).isNotNull(), F.struct(t.alias("t"), F.col(v).cast("double").alias("v")))
        out = out.withColumns({f"_p_{v}": F.last(at, True).over(back), f"_n_{v}": F.last(at, True).over(ahead)})
    new = {}
    for v in values:
        p, n = F.col(f"_p_{v}"), F.col(f"_n_{v}")
        since = (t - p["t"]) / F.lit(1e6)
        line = p["v"] + (n["v"] - p["v"]) * ((t - p["t"]).cast("double") / (n["t"] - p["t"]).cast("double"))
        new[v] = (
            F.when(F.col(v).isNotNull(), F.col(v).cast("double"))
            .when(p.isNull() | (since > limit_s), F.lit(None).cast("double"))
            .when(n.isNull(), p["v"])
            .otherwise(line)
        )
    return out.withColumns(new).drop(*(f"_{k}_{v}" for v in values for k in "pn"))


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key, the first in an order that leaves no ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")
