"""Packing documents into token sequences by non-negative least squares."""

from __future__ import annotations

import bisect
import json
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import materialize, texts

#: Letters without a space beyond which a text goes to the slower tokenizer,
#: whose merging does not grow with the square of a word.
LONG_WORD = 4000

Pattern = tuple[tuple[tuple[int, int], ...], int]


class ByteBpe:
    """Ids of a byte-level BPE file; both libraries give the same, one is faster."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.long = regex.compile(rf"\S{{{LONG_WORD},}}|\s{{{LONG_WORD},}}")

    def __call__(self, text: str) -> np.ndarray:
        if self.long.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def tokenise(docs: DataFrame, path: str, window: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id``, ``doc_tokens`` and ``crcs``, a checksum for each ``window`` ids of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for batch in batches:
            n, crcs = [], []
            for t in texts(batch.column(1)):
                ids = np.append(bpe(t.decode("utf-8", "replace")), np.array([end_id], "<u4")).astype("<u4")
                n.append(len(ids))
                crcs.append([zlib.crc32(ids[i : i + window].tobytes()) for i in range(0, len(ids), window)])
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names=["id", "doc_tokens", "crcs"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, doc_tokens long, crcs array<long>"
    )


def fillings(hist: np.ndarray, window: int, picks: int = 12) -> list[tuple[int, ...]]:
    """Shallow combinations of the lengths at hand that fill a window exactly.

    All pairs; for each length some triples whose second part is spread over the
    lengths at hand; and copies of one length with one other.
    """
    have = np.flatnonzero(hist[:window])
    there = hist > 0
    found = set()
    for a in have.tolist():
        if there[window - a]:
            found.add(tuple(sorted((a, window - a))))
        second = have[have < window - a]
        second = second[there[window - a - second]]
        for b in second[np.linspace(0, len(second) - 1, min(picks, len(second))).astype(int)].tolist() if len(second) else ():
            found.add(tuple(sorted((a, b, window - a - b))))
        for k in range(2, min(8, window // a) + 1):
            rest = window - k * a
            if rest == 0 or (0 < rest < window and there[rest]):
                found.add(tuple(sorted([a] * k + [rest] * (rest > 0))))
    return sorted(found)


def nnls(combos: list[tuple[int, ...]], hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used close to the histogram in least squares.

    Accelerated projected gradient; the matrix has a few entries in each column
    and is kept as index lists.
    """
    col = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    row = np.array([length for c in combos for length in c], dtype=np.int64)
    size, n = len(hist), len(combos)
    h = hist.astype(float)
    use = lambda x: np.bincount(row, x[col], size)
    back = lambda r: np.bincount(col, r[row], n)
    v = np.ones(n)
    for _ in range(30):
        v = back(use(v))
        v /= (top := np.linalg.norm(v)) or 1
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(use(y) - h) / (1.01 * top))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, y, t = new, new + (t - 1) / t2 * (new - x), t2
    return x


def plan(hist: np.ndarray, window: int) -> list[Pattern]:
    """Patterns, each a list of (length, copies), and how often each is used, for all pieces.

    ``hist[length]`` counts pieces.  The histogram has ``window`` entries at most,
    whatever the number of documents.
    """
    left = hist.astype(np.int64).copy()
    out: list[Pattern] = []
    if left[window]:
        out.append((((window, 1),), int(left[window])))
        left[window] = 0
    combos = fillings(left, window)
    if combos:
        x = nnls(combos, left)
        for k in np.argsort(-x, kind="stable").tolist():
            if x[k] < 0.5:
                break
            need = Counter(combos[k])
            times = min(round(x[k]), *(int(left[a]) // m for a, m in need.items()))
            if times > 0:
                out.append((tuple(sorted(need.items(), reverse=True)), times))
                for a, m in need.items():
                    left[a] -= m * times
    have = np.flatnonzero(left).tolist()
    while have:  # residuals: the longest first, then whatever fits best
        space, need = window, {}
        while space and (k := bisect.bisect_right(have, space)):
            a = have[k - 1]
            while a in need and k > 1 and need[a] == left[a]:
                k -= 1
                a = have[k - 1]
            free = int(left[a]) - need.get(a, 0)
            m = min(free, space // a)
            if not m:
                break
            need[a] = need.get(a, 0) + m
            space -= m * a
        times = min(int(left[a]) // m for a, m in need.items())
        out.append((tuple(sorted(need.items(), reverse=True)), times))
        for a, m in need.items():
            left[a] -= m * times
            if not left[a]:
                have.remove(a)
    return out


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: from rank ``rank`` on, piece by piece to sequences from ``seq`` on."""
    rows = []
    taken: Counter = Counter()
    seq = 0
    for need, times in patterns:
        offset = 0
        for a, m in need:
            for _ in range(m):
                rows.append((a, taken[a], seq, offset))
                taken[a] += times
                offset += a
        seq += times
    cols = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "seq", "offset"), cols.T, strict=True))


def pack(
    docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids.

    A document is cut into whole windows and a rest.  The histogram of lengths
    (``window`` numbers) goes to the driver, which enumerates combinations of a
    few lengths that fill a window, solves their repeat counts by non-negative
    least squares, rounds them as far as there are pieces, and packs what is left greedily.  Pieces
    of a length are alike, so each finds its place by its rank among them.
    Ranks come from salted groups and sums over the groups, so that one common
    length does not land in one task.

    Returns one row per piece: the id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``.  Null or empty text gives the
    end id alone.  Repeated rows are packed each; an empty table gives an empty
    result; other columns are ignored.
    """
    done = materialize(tokenise(docs, path, window, end_id, id_col, text_col), "tokens")
    groups = max(1, math.isqrt(done.count()))  # then neither a group of one length nor the number of groups grows fast
    pieces = done.select("id", "doc_tokens", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        "id",
        (F.col("k") * F.lit(window).cast("long")).alias("start"),
        F.least(F.lit(window).cast("long"), F.col("doc_tokens") - F.col("k") * window).alias("length"),
        "ids_crc32",
        "doc_tokens",
        F.pmod(F.xxhash64("id", "k"), F.lit(groups)).alias("salt"),
    )
    counts = materialize(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    hist = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``window`` rows
        hist[length] = n
    place = slots(plan(hist, window))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("rank", F.row_number().over(within) - 1)
        .join(base, ["length", "salt"])
        .select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("base")).alias("rank"))
    )
    key = place["length"] << 44 | place["rank"]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            seq = place["seq"][at] + rank - place["rank"][at]
            cols = [*batch.columns[:5], pa.array(seq), pa.array(place["offset"][at])]
            yield pa.record_batch(cols, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = ranked.mapInArrow(
        seat, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return out.withColumnRenamed("id", id_col)
