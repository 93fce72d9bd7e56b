"""Calibrations by bucket of time, so that what a day reads does not grow with the history.

A bucket holds its calibrations and, as its edges, for each key the last two
before it and the first two after it, wherever those are.  The rows around any
time are then the buckets that it touches and the edges of the first and the
last of these: lines between neighbours, lines that go on beyond a key's ends,
and brackets come out as from the whole history.

A store has one writer at a time.  An update writes beside the store and
renames at the end; one that was stopped while renaming is noticed, and the next
builds all anew, as it does where a known file has changed or gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklake.functions.clock import micros, of_micros

#: Seconds of a bucket.
BUCKET_S = 30 * 86_400
POINTS = "kind string, instrument string, parameter string, t long, v double, i double"
FILES = "path string, size long, changed long"
KEY = ["kind", "instrument", "parameter"]
Tables = tuple[DataFrame, DataFrame, DataFrame]


def as_points(slopes: DataFrame, sensitivities: DataFrame, zeros: DataFrame, time: str = "sample_time") -> DataFrame:
    """Slopes, sensitivities and zeros as rows of one table; rows without a time or instrument, and named ones without a parameter, go."""

    def rows(df: DataFrame, kind: str, parameter: Column, v: str, i: Column) -> DataFrame:
        fine = F.col(time).isNotNull() & F.col("instrument").isNotNull() & (F.lit(kind == "sensitivity") | parameter.isNotNull())
        return df.filter(fine).select(F.lit(kind).alias("kind"), "instrument", parameter.alias("parameter"), micros(time).alias("t"), F.col(v).cast("double").alias("v"), i.cast("double").alias("i"))

    none, name = F.lit(None), F.col("parameter")
    once = sensitivities.select("instrument", time, "ksens").distinct()
    return rows(slopes, "slope", name, "slope", F.col("intercept")).unionByName(rows(once, "sensitivity", none.cast("string"), "ksens", none)).unionByName(rows(zeros, "zero", name, "zero", none))


def as_tables(points: DataFrame) -> Tables:
    """The three tables of ``as_points`` again."""
    at = points.withColumn("sample_time", of_micros(F.col("t")))
    kind = lambda k: at.filter(F.col("kind") == k)
    return (
        kind("slope").select("instrument", "parameter", "sample_time", F.col("v").alias("slope"), F.col("i").alias("intercept")),
        kind("sensitivity").select("instrument", "sample_time", F.col("v").alias("ksens")),
        kind("zero").select("instrument", "parameter", "sample_time", F.col("v").alias("zero")),
    )


def edges(points: DataFrame, buckets: list[int]) -> DataFrame:
    """For each bucket and key the last two points before it and the first two after it (``side``).

    A key's points are looked at only where they are among the first or last two
    of a bucket; each stretch between two of its buckets is dealt to the
    buckets in between, by their ranks among all.
    """
    known = points.sparkSession.createDataFrame(list(enumerate(buckets)), "rank long, bucket long")  # a row for each folder
    inside = Window.partitionBy(*KEY, "bucket")
    at, a, d = F.struct("t", "v", "i"), F.col("_a") <= 2, F.col("_d") <= 2
    ranked = points.withColumns({"_a": F.row_number().over(inside.orderBy("t", "v")), "_d": F.row_number().over(inside.orderBy(F.desc("t"), F.desc("v")))}).filter(a | d)
    ends = ranked.groupBy(*KEY, "bucket").agg(F.array_sort(F.collect_list(F.when(a, at))).alias("first"), F.array_sort(F.collect_list(F.when(d, at))).alias("last"))
    over = Window.partitionBy(*KEY).orderBy("bucket")
    up_to = F.flatten(F.collect_list("last").over(over.rowsBetween(-1, 0)))
    onward = F.flatten(F.collect_list("first").over(over.rowsBetween(0, 1)))
    following, preceding = F.lead("rank").over(over), F.lag("rank").over(over)
    held = ends.join(F.broadcast(known), "bucket").withColumns({"_up": F.slice(up_to, F.greatest(F.size(up_to) - 1, F.lit(1)), F.lit(2)), "_on": F.slice(onward, 1, 2), "_next": following, "_prev": preceding})
    stretch = lambda side, low, high, carried: F.struct(F.lit(side).alias("side"), low.alias("low"), high.alias("high"), F.col(carried).alias("p"))
    before = stretch("before", F.col("rank") + 1, F.coalesce("_next", F.lit(len(buckets) - 1).cast("long")), "_up")
    after = stretch("after", F.coalesce("_prev", F.lit(0).cast("long")), F.col("rank") - 1, "_on")
    spread = held.select(*KEY, F.explode(F.array(before, after)).alias("_s")).filter("_s.low <= _s.high")
    dealt = spread.select(*KEY, "_s.side", "_s.p", F.explode(F.sequence("_s.low", "_s.high")).alias("rank")).join(F.broadcast(known), "rank")
    return dealt.select(*KEY, "side", "bucket", F.explode("p").alias("_p")).select(*KEY, "_p.*", "side", "bucket")


class CalibrationStore:
    """Calibrations in a folder: ``absorb`` files or ``put`` rows, then ask for those ``around`` a stretch of time."""

    def __init__(self, spark: SparkSession, folder: str, bucket_s: int = BUCKET_S) -> None:
        self.spark, self.folder, self.us = spark, folder.rstrip("/"), bucket_s * 1_000_000

    # folders

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _there(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _move(self, source: str, target: str) -> None:
        if not self._there(source):
            return
        fs, p = self._fs(target)
        fs.delete(p, True)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._fs(source)[1], p):
            raise OSError(f"{target} could not be put in place")

    def _state(self, path: str) -> tuple[str, int, int]:
        """Size and time of change of a file, or of what a folder of part files holds."""
        fs, p = self._fs(path)
        whole = fs.getFileStatus(p)
        parts = list(fs.listStatus(p)) if whole.isDirectory() else [whole]
        return path, sum(s.getLen() for s in parts), max([whole.getModificationTime(), *(s.getModificationTime() for s in parts)])

    def buckets(self, what: str = "points") -> list[int]:
        """Numbers of the buckets that hold calibrations."""
        if not self._there(f"{self.folder}/{what}"):
            return []
        fs, p = self._fs(f"{self.folder}/{what}")
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))

    def _read(self, what: str, chosen: list[int], schema: str, listed: list[int] | None = None) -> DataFrame:
        there = set(self.buckets(what) if listed is None else listed)
        paths = [f"{self.folder}/{what}/bucket={b}" for b in chosen if b in there]
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, bucket long")
        if len(paths) == len(there):
            paths = [f"{self.folder}/{what}"]
        return self.spark.read.schema(f"{schema}, bucket long").option("basePath", f"{self.folder}/{what}").parquet(*paths)

    def _write(self, df: DataFrame, path: str, n: int) -> None:
        """A file for each of ``n`` buckets, dealt to all cores: small as they are, each takes its time to open and close."""
        tasks = max(1, min(n, 2 * self.spark.sparkContext.defaultParallelism))
        df.repartition(tasks, "bucket").sortWithinPartitions("bucket", *KEY, "t", "v").write.partitionBy("bucket").parquet(path)

    # writing

    def absorb(self, files: dict[str, list[str]], read: Callable[[dict[str, list[str]]], Tables]) -> int:
        """Take in the files that are not known yet, by lists under the names that ``read`` is given; says how many were read."""
        now = {path: self._state(path) for paths in files.values() for path in paths}
        known = {} if self._broken() or not self._there(f"{self.folder}/files") else {r.path: tuple(r) for r in self.spark.read.parquet(f"{self.folder}/files").collect()}
        anew = any(now.get(path) != state for path, state in known.items())
        new = [path for path in now if anew or path not in known]
        if not new and not anew and self._there(f"{self.folder}/files"):
            return 0
        chosen = set(new)
        self.put(*read({name: [p for p in paths if p in chosen] for name, paths in files.items()}), files=list(now.values()), anew=anew or not known)
        return len(new)

    def put(self, slopes: DataFrame, sensitivities: DataFrame, zeros: DataFrame, files: list[tuple[str, int, int]] = (), anew: bool = False) -> None:
        """Add rows, or with ``anew`` let them replace all that is there.

        Points of the buckets that get rows are rewritten, and the edges of all
        buckets: an update reads the table of points, which no other use does.
        """
        if self._broken() and not anew:
            raise ValueError(f"{self.folder} is incomplete, as an update was stopped: build it anew")
        staging = f"{self.folder}/_new_{uuid.uuid4().hex}"
        fresh = as_points(slopes, sensitivities, zeros).withColumn("bucket", F.floor(F.col("t") / F.lit(self.us)).cast("long"))
        fresh.write.parquet(f"{staging}/fresh")
        fresh = self.spark.read.parquet(f"{staging}/fresh")
        touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())
        there = [] if anew else self.buckets()
        new = set(touched)
        now = self._read("points", [b for b in there if b in new], POINTS, there).unionByName(fresh)
        self._write(now, f"{staging}/points", len(touched))
        if touched:
            written = self.spark.read.schema(f"{POINTS}, bucket long").parquet(f"{staging}/points")
            rest = self._read("points", [b for b in there if b not in new], POINTS, there)
            every = sorted({*there, *touched})
            self._write(edges(rest.unionByName(written), every), f"{staging}/edges", len(every))
        self.spark.createDataFrame(list(files), FILES).coalesce(1).write.parquet(f"{staging}/files")
        fs, mark = self._fs(f"{self.folder}/_renaming")
        fs.create(mark, True).close()
        if anew:
            for what in ("points", "edges"):
                self._delete(f"{self.folder}/{what}")
        if touched and new.issuperset(there):  # all are new: one move
            self._move(f"{staging}/points", f"{self.folder}/points")
        else:
            for b in touched:
                self._move(f"{staging}/points/bucket={b}", f"{self.folder}/points/bucket={b}")
        self._move(f"{staging}/edges", f"{self.folder}/edges")
        self._move(f"{staging}/files", f"{self.folder}/files")
        fs.delete(mark, False)
        self._delete(staging)

    def _broken(self) -> bool:
        return self._there(f"{self.folder}/_renaming")

    # reading

    def around(self, low: datetime | int | None, high: datetime | int | None) -> Tables:
        """Slopes, sensitivities and zeros that readings from ``low`` to ``high`` (times, or microseconds) can need; none for none."""
        if self._broken():
            raise ValueError(f"{self.folder} is incomplete, as an update was stopped: build it anew")
        return as_tables(self._around(low, high))

    def _around(self, low: datetime | int | None, high: datetime | int | None) -> DataFrame:
        there = self.buckets()
        if low is None or high is None or not there:
            return self.spark.createDataFrame([], POINTS)
        first, last = (self._bucket(x) for x in (low, high))
        chosen = [b for b in there if first <= b <= last]
        if first not in chosen:
            chosen = [b for b in there if b < first][-1:] + chosen or there[:1]
        inside = self._read("points", chosen, POINTS)
        sides = [self._read("edges", [b], f"{POINTS}, side string").filter(F.col("side") == side) for b, side in ((chosen[0], "before"), (chosen[-1], "after"))]
        names = [f.split()[0] for f in POINTS.split(", ")]
        return inside.select(names).unionByName(sides[0].select(names)).unionByName(sides[1].select(names))

    def _bucket(self, at: datetime | int) -> int:
        us = at if isinstance(at, int) else self.spark.range(1).select(micros(F.lit(at))).first()[0]
        return us // self.us
