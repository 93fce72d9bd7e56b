"""Exact deduplication by sorting content."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, materialize, numbered

#: Letters of a text that the sort key holds; a digest stands for the rest.
KEY_LETTERS = 32

_RUN = "_id {kind}, text_sha256 string, pid int, size long, top {kind}, tail boolean, run int, border string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare neighbours of a sorted partition and emit each run of equal texts.

    A run is held until its last row is seen; only identifiers and digests are
    held, and the text of the latest row.  The first (0) and the last run (1)
    of the partition may go on in a neighbouring one; they are numbered, and
    their last rows carry the text, for the comparison across borders.
    """
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    ids: list = []
    sha = last = None
    first = True

    def emit(run: int | None) -> pa.RecordBatch:
        rows = pa.concat_arrays(ids)
        n = len(rows)
        known = rows.drop_null()
        top = known[len(known) - 1] if len(known) else pa.scalar(None, rows.type)
        return pa.record_batch(
            {
                "_id": rows,
                "text_sha256": pa.repeat(sha, n),
                "pid": pa.repeat(pa.scalar(pid, pa.int32()), n),
                "size": pa.repeat(pa.scalar(n, pa.int64()), n),
                "top": pa.repeat(top, n),
                "tail": pa.array([False] * (n - 1) + [True]),
                "run": pa.repeat(pa.scalar(run, pa.int32()), n),
                "border": pa.array([None] * (n - 1) + [None if run is None else of.as_py()], pa.string()),
            }
        )

    out: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text, sha_of, id_of = (batch.column(i) for i in range(3))
        starts = [0] if last is None or text[0] != last else []
        starts += [i + 1 for i in pc.indices_nonzero(pc.not_equal(text.slice(1), text.slice(0, n - 1))).to_pylist()]
        at = 0
        for start in [*starts, n]:
            if start > at:
                ids.append(id_of.slice(at, start - at))
            if start < n:
                if ids:
                    out.append(emit(0 if first else None))
                    first = False
                ids, sha, of = [], sha_of[start], text[start]
            at = start
        last = text[n - 1]
        held += n
        if held >= 4096 and out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out, held = [], 0
    if ids:
        out.append(emit(0 if first else 1))
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run of equal texts in a sorted partition the last row, whole, with the run's number as in ``_runs``."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    held = None
    first = True

    def mark(rows: pa.RecordBatch, runs: list[int | None]) -> pa.RecordBatch:
        new = [pa.repeat(pa.scalar(pid, pa.int32()), rows.num_rows), pa.array(runs, pa.int32())]
        return pa.RecordBatch.from_arrays([*rows.columns, *new], names=[*rows.schema.names, "pid", "run"])

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("_text")
        ends = pc.indices_nonzero(pc.not_equal(text.slice(1), text.slice(0, batch.num_rows - 1)))
        if held is not None and held.column("_text")[0] != text[0]:
            yield mark(held, [0 if first else None])
            first = False
        if len(ends):
            yield mark(batch.take(ends), [0 if first else None] + [None] * (len(ends) - 1))
            first = False
        held = batch.slice(batch.num_rows - 1)
    if held is not None:
        yield mark(held, [0 if first else 1])


def _chains(edges: DataFrame) -> dict[tuple[int, int], int]:
    """A number for each run at a partition's edge (pid, run, text), the same for runs of one text.

    The last run of each partition is compared in full with the first of the
    next one that has rows.  Only numbers reach the driver, at most two rows
    for each partition.
    """
    runs = sorted(tuple(r) for r in edges.select("pid", "run").collect())
    first, last = dict(reversed(runs)), dict(runs)
    pids = sorted(first)
    steps = [(a, last[a], b, first[b]) for a, b in zip(pids, pids[1:], strict=False)]
    steps = edges.sparkSession.createDataFrame(steps, "pid int, run int, next_pid int, next_run int")
    after = edges.select(F.col("pid").alias("next_pid"), F.col("run").alias("next_run"), F.col("text").alias("next_text"))
    goes_on = steps.join(edges, ["pid", "run"]).join(after, ["next_pid", "next_run"]).filter("text = next_text")
    linked = {r[0] for r in goes_on.select("next_pid").collect()}
    out, chain = {}, 0
    for pid in pids:
        for run in dict.fromkeys((first[pid], last[pid])):
            chain += run != first[pid] or pid not in linked
            out[pid, run] = chain
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those whose text another row with a larger id repeats.

    The same sort as in ``content_sort_dedup``; the rows go through it whole, so
    that they need no second shuffle, and a text travels once.  Null text equals
    empty text; of rows that repeat id and text one stays; rows without an id
    stay only if no row of the group has one; an empty table stays empty.
    Columns of any names pass through.
    """
    rows, (i, t) = numbered(docs, id_col, text_col)
    once = rows.withColumns({"_text": F.coalesce(t, F.lit("")), "_none": F.col(t).isNull(), "_id": F.col(i)}).drop(t)  # each text travels once
    ready = _sorted(once).drop("_sha")
    fields = T.StructType([*ready.schema.fields, T.StructField("pid", T.IntegerType()), T.StructField("run", T.IntegerType())])
    tails = materialize(ready.mapInArrow(_tails, fields).drop("_id"), "tails")
    chain = _chains(tails.filter("run IS NOT NULL").select("pid", "run", F.col("_text").alias("text")))
    last = {k: p for (p, _), k in sorted(chain.items())}  # null ids sort first, so the last partition has the largest id
    early = [key for key, k in chain.items() if last[k] != key[0]]
    early = docs.sparkSession.createDataFrame(early, "pid int, run int")  # at most two rows for each partition
    kept = tails.join(F.broadcast(early), ["pid", "run"], "left_anti").withColumn(t, F.when(~F.col("_none"), F.col("_text")))
    return kept.select(*rows.columns).toDF(*docs.columns)


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows with ``_text`` and ``_id``, range-partitioned and sorted so that equal texts are side by side."""
    keyed = rows.withColumns({"_sha": F.sha2(F.col("_text"), 256), "_key": F.substring("_text", 1, KEY_LETTERS)})
    key = ["_key", "_sha", "_id"]
    return keyed.repartitionByRange(*key).sortWithinPartitions(*key).drop("_key")


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group rows by identical text; of equal texts the row with the largest id stays.

    Sampled splitters range-partition the rows, Spark's external sort places
    equal texts side by side, and each text is compared in full with the one
    before it.  The sort key is the text's first ``KEY_LETTERS`` letters, then a
    digest for what lies beyond them, then the id: splitters stay small however
    long the texts are, and can cut through a large group of copies, so that no
    task holds a whole group.  A group that crosses partition borders is joined
    again from the runs at the borders, of which each partition has at most
    two; these are compared in full, too.

    Returns one row per input row: the id, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``.  Null text counts as empty; texts of any length
    are compared whole.  Rows without an id take part and stay only if no row
    of the group has one; of rows that repeat both id and text one stays.  An
    empty table gives an empty result; other columns, whatever their names, are
    ignored.
    """
    base = docs.select(F.coalesce(column(text_col), F.lit("")).alias("_text"), column(id_col).alias("_id"))
    kind = base.schema["_id"].dataType.simpleString()
    ready = _sorted(base).select("_text", "_sha", "_id")
    runs = materialize(ready.mapInArrow(_runs, _RUN.format(kind=kind)), "runs")
    edges = runs.filter("run IS NOT NULL AND tail")
    chain = _chains(edges.select("pid", "run", F.col("border").alias("text")))
    size, top, last = {}, {}, {}
    for r in sorted(edges.select("pid", "run", "size", "top").collect(), key=lambda r: (r.pid, r.run)):  # at most two rows for each partition
        k = chain[r.pid, r.run]
        size[k], last[k] = size.get(k, 0) + r.size, r.pid
        top[k] = top.get(k) if r.top is None else r.top  # ids rise along a chain
    joined = [(*key, size[k], top[k], last[k]) for key, k in chain.items()]
    joined = docs.sparkSession.createDataFrame(joined, f"pid int, run int, all_size long, all_top {kind}, last_pid int")
    return runs.join(F.broadcast(joined), ["pid", "run"], "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("all_top", "top").alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("tail") & (F.col("pid") == F.coalesce("last_pid", "pid"))).alias("kept"),
        "text_sha256",
    )
