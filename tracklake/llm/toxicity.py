"""Toxicity: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, numbered, texts

#: Labelled rows of either kind that the model is fitted on, at most.
TOXIC_ROWS, CLEAN_ROWS = 3_000, 6_000
#: Features kept, and the least z value of the difference in their document shares.
FEATURES, LEAST_Z = 512, 5.0
#: Marked words from which on a toxic text has grade 2 and grade 3; below, grade 1.
GRADE_EDGES = (3, 6)
#: A text is rejected from this probability of grade 1 or more on: a toxic text
#: that stays costs more than a doubtful one that goes.
REJECT = 0.25

_WORD = regex.compile(r"\p{L}+")
_KNOWN_WORDS = 500_000


def word_features(word: str) -> list[str]:
    """A word, and its stems of four and five letters, which inflected forms share."""
    return [word, *(f"{word[:k]}*" for k in (4, 5) if len(word) > k)]


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds: P(grade >= k) = logistic(w.x - threshold[k-1])."""

    features: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each row the probabilities of grade 1 or more, 2 or more, and so on."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - (x @ self.weights)[:, None], -500, 500)))


class Features:
    """The chosen features of a text: each enters the model by its count and by its share of the words.

    One chance hit in a long text then weighs less than several in a short one.
    """

    def __init__(self, features: list[str]) -> None:
        self.at = {f: k for k, f in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> tuple[list[int], list[float]]:
        """Positions and values of the entries that are not zero."""
        words = _WORD.findall(text.decode("utf-8", "replace").lower())
        out: Counter = Counter()
        for word, n in Counter(words).items():
            if (hit := self.known.get(word)) is None:
                if len(self.known) > _KNOWN_WORDS:
                    self.known.clear()
                hit = self.known[word] = tuple(self.at[f] for f in word_features(word) if f in self.at)
            for k in hit:
                out[k] += n
        at, n = list(out), np.fromiter(out.values(), float, len(out))
        values = np.concatenate((np.log1p(n), np.log1p(100.0 * n / max(1, len(words)))))
        return at + [k + len(self.at) for k in at], values.tolist()


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, penalty: float = 1e-3, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model with an L2 penalty, by Adam.

    The thresholds are a first value plus positive steps, so they stay in order.
    """
    x = np.ascontiguousarray(x, dtype=np.float64)
    n, d = x.shape
    w, cut = np.zeros(d), np.concatenate(([1.0], np.full(grades - 2, 0.0)))
    m, v = np.zeros(d + grades - 1), np.zeros(d + grades - 1)
    for step in range(1, steps + 1):
        theta = np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:]))))
        f = 1.0 / (1.0 + np.exp(np.clip(theta - (x @ w)[:, None], -60, 60)))
        f = np.column_stack((np.ones(n), f, np.zeros(n)))
        low, high = f[np.arange(n), y], f[np.arange(n), y + 1]
        p = np.maximum(low - high, 1e-12)
        by_cut = np.zeros((n, grades + 1))
        by_cut[np.arange(n), y] += low * (1 - low) / p
        by_cut[np.arange(n), y + 1] -= high * (1 - high) / p
        by_theta = by_cut[:, 1:grades].mean(axis=0)  # of the negative log-likelihood
        tail = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate((-(x.T @ (1 - low - high)) / n + penalty * w, tail[:1], tail[1:] * np.exp(cut[1:])))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, cut = w - move[:d], cut - move[d:]
    return w, np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:]))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> OrdinalModel:
    """Fit the model on a bounded sample of labelled rows.

    The sample is the labelled ids that come first by a hash, ``TOXIC_ROWS`` and
    ``CLEAN_ROWS`` of them at most, with one row each, the one whose text comes
    first; only they, their counts of chosen features and the chosen features
    reach the driver.  Labels that are null or other than 0 and 1 do not count,
    of several for one id the greatest does.  Without labelled rows of both
    kinds the model has no features and rejects nothing.  Features are the words and stems
    whose document shares differ most.  Labels only say toxic or not, so the
    severity of a toxic text is graded by how many of its words are marked: have
    a feature that is hardly ever found in clean texts.
    """
    docs = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    labels = labels.select(column(id_col).alias("id"), column(label_col).alias("y"))
    known = labels.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("id")
    some = [known.filter(F.col("y") == y).orderBy(order, "id").limit(n) for y, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    ids = {r[0]: r[1] for part in some for r in part.collect()}
    empty = OrdinalModel([], np.zeros(0), np.array([10.0, 11.0, 12.0]))
    if not ids:
        return empty
    spark = docs.sparkSession
    marked = spark.createDataFrame(list(ids.items()), f"id {docs.schema['id'].dataType.simpleString()}, y int")
    sample = docs.join(F.broadcast(marked), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    sample = materialize(sample.select("y", "text"), "toxic-sample")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = {}
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                for f in {f for w in set(_WORD.findall(t.decode("utf-8", "replace").lower())) for f in word_features(w)}:
                    sums.setdefault(f, [0, 0])[y] += 1
        yield pa.record_batch([pa.array(list(sums), pa.string()), *(pa.array([v[k] for v in sums.values()], pa.int64()) for k in (0, 1))], names=["f", "clean", "toxic"])

    totals = dict(sample.groupBy("y").count().collect())
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return empty
    p = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    z = (F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(p * (1 - p) * (1.0 / n0 + 1.0 / n1))
    chosen = (
        sample.mapInArrow(shares, "f string, clean long, toxic long")
        .groupBy("f")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((F.col("clean") + F.col("toxic") < n0 + n1) & (F.col("clean") + F.col("toxic") > 1))
        .select("f", "clean", "toxic", z.alias("z"))
        .filter(F.abs("z") >= LEAST_Z)
        .orderBy(F.desc(F.abs("z")), "f")
        .limit(FEATURES)
        .collect()
    )
    features = [r.f for r in chosen]
    marks = {r.f for r in chosen if r.toxic / n1 > 50 * max(r.clean, 0.5) / n0}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(features)
        for batch in batches:
            found = list(texts(batch.column(1)))
            rows = [of(t) for t in found]
            hits = [sum(any(f in marks for f in word_features(w)) for w in _WORD.findall(t.decode("utf-8", "replace").lower())) for t in found]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(hits, pa.int64()),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                ],
                names=["y", "hits", "at", "value"],
            )

    rows = sorted(sample.mapInArrow(counts, "y int, hits long, at array<int>, value array<double>").collect())
    x, grade = np.zeros((len(rows), 2 * len(features)), np.float32), np.zeros(len(rows), np.int64)
    for i, r in enumerate(rows):
        x[i, r.at] = r.value
        grade[i] = r.y * (1 + sum(r.hits >= e for e in GRADE_EDGES))
    w, theta = fit_ordinal(x, grade, len(GRADE_EDGES) + 2)
    return OrdinalModel(features, w, theta)


def _graded(model: OrdinalModel, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch, whose last column is the text, with the probabilities of its rows."""
    of = Features(model.features)
    for batch in batches:
        x = np.zeros((batch.num_rows, 2 * len(model.features)))
        for i, t in enumerate(texts(batch.columns[-1])):
            at, value = of(t)
            x[i, at] = value
        yield batch, model.probabilities(x)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Expected severity of every whole text, without a shuffle.

    Returns one row per input row, repeated ones too: the id, ``severity`` (the
    expected grade, from 0 on), ``p_toxic`` (of grade 1 or more), ``grade`` (the
    likeliest) and ``rejected``.  Null and empty texts score as texts without
    any feature.  An empty table gives an empty result; other columns, whatever
    their names, are ignored.
    """
    base = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in _graded(model, batches):
            steps = -np.diff(np.column_stack((np.ones(len(p)), p, np.zeros(len(p)))), axis=1)
            new = [pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(steps.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= REJECT)]
            yield pa.record_batch([batch.column(0), *new], names=["id", "severity", "p_toxic", "grade", "rejected"])

    kind = base.schema["id"].dataType.simpleString()
    out = base.mapInArrow(run, f"id {kind}, severity double, p_toxic double, grade int, rejected boolean")
    return out.withColumnRenamed("id", id_col)


def drop_rejected(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns of any names, without those that ``score`` rejects."""
    rows, (t,) = numbered(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, p in _graded(model, batches):
            whole = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            yield whole.filter(pa.array(p[:, 0] < REJECT))

    return rows.withColumn("text", F.col(t)).mapInArrow(run, rows.schema).toDF(*docs.columns)
