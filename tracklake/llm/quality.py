"""Quality: two classifiers, on content and on metadata, that train each other."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialize, spread, texts

#: Labelled rows of either kind that training sees, at most; rows without a label are all seen.
GOOD_ROWS, BAD_ROWS = 4_000, 3_000
#: Rounds of co-training, and rows of either kind that a view passes on in a round.
ROUNDS, PASSED = 5, 60
#: A view passes on rows from these odds (logarithms of 0.2 to 0.8 and 0.9 to 0.1) on.
SURE_BAD, SURE_GOOD = -np.log(4.0), np.log(9.0)
#: A document is kept from this combined probability of good quality on.
KEEP = 0.35

_SOURCES = 32
_LANGS = 16


def content_features(text: bytes) -> np.ndarray:
    """Shares of kinds of bytes and of words: what the text itself is made of."""
    n = max(1, len(text))
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lower, upper = hist[97:123].sum(), hist[65:91].sum()
    marks = [hist[ord(c)] / n for c in ".,!?$%&*#|<>={}@:;/-\"'"]
    words = text.split()
    m = max(1, len(words))
    count = Counter(words)
    top = max(count.values(), default=0)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.array(
        [
            1.0,
            lower / n,
            upper / n,
            hist[48:58].sum() / n,
            hist[128:].sum() / n,
            (upper / max(1, upper + lower)) ** 0.5,
            *(np.sqrt(10 * x) for x in marks),
            sum(map(len, words)) / m / 10,
            len(count) / m**0.8,
            top / m if m > 20 else 0.0,
            pairs / m,
            np.log(m) / 10,
        ]
    )


def metadata_features(text: bytes, lang: str | None, source: str | None) -> np.ndarray:
    """What is known of the page around its words: source, language, size, layout."""
    lines = text.split(b"\n")
    n = max(1, len(text))
    count = Counter(lines)
    repeated = sum(len(x) * k for x, k in count.items() if k > 1 and x)
    out = np.zeros(8 + _LANGS + _SOURCES)
    out[:8] = (
        1.0,
        np.log(n) / 10,
        np.log(len(lines)) / 5,
        np.log1p(n / len(lines)) / 10,
        repeated / n,
        np.log1p(max(map(len, lines))) / 10,
        sum(not x for x in lines) / len(lines),
        sum(x[-1:] in b".!?" for x in lines if x) / len(lines),
    )
    for value, at, size in ((lang, 8, _LANGS), (source, 8 + _LANGS, _SOURCES)):
        if value is not None:
            out[at + xxhash.xxh32_intdigest(value.encode()) % size] = 0.3
    return out


#: The number of content features.
_CONTENT = len(content_features(b""))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    total = weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) / total + penalty * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x / total + penalty * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


@dataclass
class QualityModel:
    """Weights of both views, and for each the slope and offset that calibrate its score."""

    content: np.ndarray
    metadata: np.ndarray
    scale: np.ndarray

    def probabilities(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by content, by metadata, and combined."""
        za = self.scale[0, 0] * (a @ self.content) + self.scale[0, 1]
        zb = self.scale[1, 0] * (b @ self.metadata) + self.scale[1, 1]
        both = self.scale[2, 0] * za + self.scale[2, 1] * zb + self.scale[2, 2]
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (za, zb, both))


def _surest(a: np.ndarray, b: np.ndarray, key: np.ndarray, weights: list[np.ndarray], quota: list[int], taken: list[set[int]]) -> Iterator[tuple]:
    """(view, label, score, row) of the rows that each view is surest of; rows of one key count once, ``taken`` ones not."""
    for k, x in enumerate((a, b)):
        z = x @ weights[k]
        free = ~np.isin(key, np.fromiter(taken[k], np.int64, len(taken[k])))
        for label, far in ((0, z), (1, -z)):
            sure = np.flatnonzero(free & (far < (SURE_BAD, -SURE_GOOD)[label]))
            order = sure[np.lexsort((key[sure], far[sure]))]
            first = np.sort(np.unique(key[order], return_index=True)[1])[: quota[label]]
            for i in order[first].tolist():
                yield k, label, float(far[i]), i


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, surest=None) -> QualityModel:
    """Co-training; ``y`` is 1, 0 or -1 where there is no label.

    Each view starts from the labelled rows.  In a round each names the rows of
    the pool that it is surest of, in the proportion of the classes, and the
    other view takes them as labelled.  The pool is the rows without a label, or
    what ``surest(weights, quota, taken)`` looks through; that gives (view,
    label, key, content, metadata) of each row.  A quarter of the labelled rows
    is set apart; on it each view's score is calibrated, then their combination.
    """
    rows = np.flatnonzero(y >= 0)
    apart = rows[::4] if len(rows) >= 40 else rows
    seed = np.setdiff1d(rows, apart) if len(rows) >= 40 else rows
    share = y[seed].mean()
    quota = [max(1, round(PASSED * (1 - share))), max(1, round(PASSED * share))]
    views, pool = (a, b), np.flatnonzero(y < 0)
    taken: list[set[int]] = [set(), set()]
    given: list[list] = [[], []]

    def own(weights: list[np.ndarray], quota: list[int], taken: list[set[int]]) -> list[tuple]:
        found = _surest(a[pool], b[pool], pool, weights, quota, taken)
        return [(k, label, int(pool[i]), a[pool[i]], b[pool[i]]) for k, label, _, i in found]

    def fit(k: int) -> np.ndarray:
        x = np.stack([*views[k][seed], *(row for _, row in given[k])])
        label = np.array([*y[seed], *(label for label, _ in given[k])], float)
        return fit_logistic(x, label, np.repeat((1.0, 0.3), (len(seed), len(given[k]))))

    for _ in range(ROUNDS):
        weights = [fit(0), fit(1)]
        for k, label, key, *row in (surest or own)(weights, quota, taken):
            taken[k].add(key)
            given[1 - k].append((label, row[1 - k]))
    weights = [fit(0), fit(1)]
    target, ones = y[apart].astype(float), np.ones(len(apart))
    scale = np.zeros((3, 3))
    for k in (0, 1):
        z = views[k][apart] @ weights[k]
        scale[k, :2] = fit_logistic(np.column_stack((z, ones)), target, ones, 1e-2)
    z = [views[k][apart] @ weights[k] * scale[k, 0] + scale[k, 1] for k in (0, 1)]
    scale[2] = fit_logistic(np.column_stack((*z, ones)), target, ones, 1e-2)
    return QualityModel(weights[0], weights[1], scale)


def _features(docs: DataFrame, id_col: str, text_col: str, finish, fields: str) -> DataFrame:
    """Apply ``finish(columns, content, metadata)`` to the features of each batch."""
    has = [c if c in docs.columns else None for c in ("lang", "source")]
    base = docs.select(
        column(id_col).alias("id"),
        column(text_col).alias("text"),
        *((F.col(c) if c else F.lit(None)).cast("string").alias(f"c{k}") for k, c in enumerate(has)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
            found = list(texts(batch.columns[-3]))
            a = np.stack([content_features(t) for t in found]) if found else np.zeros((0, 1))
            b = np.stack([metadata_features(*x) for x in zip(found, lang, source, strict=True)]) if found else np.zeros((0, 1))
            if found:
                yield finish(batch.columns[:-3], a, b)

    return base.mapInArrow(run, fields)


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Content and metadata features of packed rows."""
    x = np.stack([np.frombuffer(v, np.float32) for v in texts(column)]).astype(np.float64)
    return x[:, :_CONTENT], x[:, _CONTENT:]


def _pool(rows: DataFrame):
    """The rows that each view is surest of among all ``rows`` (columns key and f): a top-k of each batch, of each task, then of all."""

    def surest(weights: list[np.ndarray], quota: list[int], taken: list[set[int]]) -> list[tuple]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], dict[int, tuple[float, bytes]]] = {(k, label): {} for k in (0, 1) for label in (0, 1)}
            for batch in batches:
                if not batch.num_rows:
                    continue
                key = batch.column(0).to_numpy()
                for k, label, far, i in _surest(*_unpack(batch.column(1)), key, weights, quota, taken):
                    held[k, label][int(key[i])] = (far, batch.column(1)[i].as_py())
                for of, best in held.items():
                    if len(best) > quota[of[1]]:
                        held[of] = dict(sorted(best.items(), key=lambda x: (x[1][0], x[0]))[: quota[of[1]]])
            out = [(*of, key, *row) for of, best in held.items() for key, row in best.items()]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary())
            yield pa.record_batch([pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=["view", "label", "key", "far", "f"])

        found = rows.mapInArrow(run, "view int, label int, key long, far double, f binary")
        found = found.groupBy("view", "label", "key").agg(F.min("far").alias("far"), F.min("f").alias("f"))
        first = F.row_number().over(Window.partitionBy("view", "label").orderBy("far", "key"))
        best = found.withColumn("n", first).filter(F.col("n") <= F.when(F.col("label") == 0, quota[0]).otherwise(quota[1])).filter(F.col("n") <= max(quota))
        best = sorted(best.collect(), key=lambda r: (r.view, r.label, r.n))
        return [(r.view, r.label, r.key, *(x[0] for x in _unpack(pa.array([r.f], pa.binary())))) for r in best]

    return surest


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """Fit both views on a bounded sample of labelled rows and all rows without a label.

    Features of all rows are written once, in single precision.  The labelled
    sample is the ids that come first by a hash, ``GOOD_ROWS + BAD_ROWS`` at
    most, with one row each.  In each round Spark scores all rows without a
    label, those without an id too, and only the rows that the views pass on
    reach the driver.  None where there are no labels of both kinds.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    labels = labels.select(column(id_col).alias("id"), column(label_col).alias("y"))
    known = labels.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y"))
    picked: dict = {}
    for y, n in ((1, GOOD_ROWS), (0, BAD_ROWS)):
        picked |= {r[0]: y for r in known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n).collect()}
    if len(set(picked.values())) < 2:
        return None

    def finish(columns, a, b):
        packed = [x.tobytes() for x in np.column_stack((a, b)).astype(np.float32)]
        key = pa.array([xxhash.xxh3_64_intdigest(x) for x in packed], pa.uint64()).view(pa.int64())
        return pa.record_batch([columns[0], key, pa.array(packed, pa.binary())], names=["id", "key", "f"])

    every = _features(docs, id_col, text_col, finish, f"id {kind}, key long, f binary")
    every = materialize(spread(every, known, ["id"], "left"), "features")
    marked = spark.createDataFrame(list(picked.items()), f"id {kind}, y int")
    sample = every.filter("y IS NOT NULL").drop("y").join(F.broadcast(marked), "id").groupBy("id", "y").agg(F.min(F.struct("key", "f")).alias("row"))
    rows = sorted(sample.select("id", "y", "row.f").collect())
    y = np.array([r.y for r in rows])
    if not (y == 0).any() or not (y == 1).any():
        return None
    a, b = _unpack(pa.array([r.f for r in rows], pa.binary()))
    return co_train(a, b, y, _pool(every.filter("y IS NULL").select("key", "f")))


def score(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Quality of every whole text, without a shuffle.

    Returns one row per input row: the id, ``p_content``, ``p_metadata``,
    ``quality`` (combined, from 0 to 1) and ``kept``.  Null text counts as
    empty; null or absent ``lang`` and ``source`` give no feature.  Without a
    model every document has 1 and is kept.  Repeated rows are scored each; an
    empty table gives an empty result; other columns, whatever their names, are
    ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(columns, a, b):
        p = model.probabilities(a, b) if model else (np.ones(len(a)),) * 3
        return pa.record_batch([columns[0], *map(pa.array, p), pa.array(p[2] >= KEEP)], names=["id", "p_content", "p_metadata", "quality", "kept"])

    out = _features(docs, id_col, text_col, finish, f"id {kind}, p_content double, p_metadata double, quality double, kept boolean")
    return out.withColumnRenamed("id", id_col)
