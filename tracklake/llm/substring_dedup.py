"""Removal of repeated word windows, found by recompression."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, mix, numbered, powers, spread, texts

#: Rounds of naming: "r" names runs of a symbol, "p" names pairs.  Fixed, as
#: equal passages anywhere must be named alike.
ROUNDS = "rppppp"
#: Window starts that are parsed together, bytes that are hashed together, and
#: bytes of a word beyond which it is hashed by itself.
SEGMENT, BLOCK, LONG_WORD = 200_000, 1 << 20, 256

_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
_BASE = [0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4D & ~7 | 5]


def _salt(k: int) -> np.uint64:
    return np.uint64(k * int(_ODD[1]) & (1 << 64) - 1)


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[1])


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of a text, all words at once: a polynomial over its bytes.

    Words of over ``LONG_WORD`` bytes, for which such polynomials can be made to
    agree, are hashed one by one.
    """
    out = []
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > BLOCK:  # cut after a space
            end = at + BLOCK
            while end < len(text) and not _SPACE[text[end - 1]]:
                end += 1
        block = np.frombuffer(text, np.uint8)[at:end]
        space = _SPACE[block]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        h = span_hashes(_BYTES[block], 1)(start, stop)
        for k in np.flatnonzero(stop - start > LONG_WORD).tolist():
            h[k] = xxhash.xxh64_intdigest(text[at + start[k] : at + stop[k]], 7)
        out.append(h)
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


@functools.lru_cache(2)
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE[which], n), powers(pow(_BASE[which], -1, 1 << 64), n)


def span_hashes(h: np.ndarray, which: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that hashes spans [i, j) of ``h``: a polynomial modulo 2**64 over hashed words."""
    size = 1 << max(10, len(h).bit_length())
    up, down = _powers(which, size)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)))
    return lambda i, j: mix((total[j] - total[i]) * down[i] + (j - i).astype(np.uint64))


def name_rounds(h: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Recompress word sequences that lie end to end, the k-th from ``starts[k]`` on.

    Each round replaces runs of a symbol, or pairs of a left and a right symbol,
    by a new symbol.  The name of a symbol is a hash of its parts, and a hash of
    the name says whether it is left or right in a round: names are global
    without a dictionary.  With each symbol goes the span of words that
    determines it, [low, high): equal words there give the same symbol wherever
    they stand.  A symbol at the border of a sequence also hangs on what would
    stand beyond, so its span reaches beyond.

    Returns (name, start, words, low, high) of the symbols made in any round.
    """
    n = len(h)
    name, low, high, at_word = h, np.arange(n), np.arange(1, n + 1), np.arange(n)
    first = np.zeros(n, bool)
    first[starts] = True
    ends = np.append(starts[1:], n)
    out = []
    for k, kind in enumerate(ROUNDS):
        last = np.append(first[1:], True)
        before, after = np.append(low[:1], low[:-1]), np.append(high[1:], high[-1:])
        before[first], after[last] = starts - 1, ends + 1
        if kind == "r":
            head = np.append(True, (name[1:] != name[:-1]) | first[1:])
            at = np.flatnonzero(head)
            count = np.diff(np.append(at, len(name)))
            made = count > 1
            low, high = before[at], after[at + count - 1]
            name = np.where(made, mix(name[at] * _ODD[0] + count.astype(np.uint64)), name[at])
        else:
            right = mix(name + _salt(k)) >> np.uint64(63) == 1
            pair = ~right & np.append(right[1:], False) & ~last
            at = np.flatnonzero(~np.append(False, pair[:-1]))
            made = pair[at]
            mate = np.minimum(at + 1, len(name) - 1)
            low = np.where(~made & right[at], before[at], low[at])
            high = np.where(made, high[mate], np.where(right[at], high[at], after[at]))
            name = np.where(made, mix(mix(name[at]) + name[mate] * _ODD[0]), name[at])
        first, at_word = first[at], at_word[at]
        words = np.diff(np.append(at_word, n))
        out.append((name[made], at_word[made], words[made], low[made], high[made]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def anchors(h: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts that share an anchor: (name, first start, number of starts, context).

    The anchor of a window is the longest symbol whose determining span lies in
    the window, of equally long ones the one whose name is greatest, of equal
    names the leftmost of the earliest round.  So equal windows have equal anchors.  A window without
    any, as in a long run of one word, is its own anchor.  The context is a
    hash of all words that the run's windows cover.
    """
    n = len(h)
    ends = np.append(starts[1:], n)
    free = np.zeros(n + 1, np.int64)
    fits = ends - starts >= window
    np.add.at(free, starts[fits], 1)
    np.add.at(free, ends[fits] - window + 1, -1)
    todo = np.cumsum(free[:n]) > 0
    if not todo.any():
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none.view(np.uint64)
    name, start, words, low, high = name_rounds(h, starts)
    good = high - low <= window
    name, start, words, low, high = (x[good] for x in (name, start, words, low, high))
    rank = np.minimum(words, 63).astype(np.uint64) << np.uint64(58) | name >> np.uint64(6)
    order = len(rank) - 1 - np.argsort(rank[::-1], kind="stable")  # from the least to the best, of equal ones the first last
    name, low, high = name[order], low[order], high[order]
    best = _cover(np.maximum(high - window, 0), low + 1, n)
    which = np.where(todo, best, -2)
    own = np.flatnonzero(which == -1)
    which[own] = len(name) + own
    spans = span_hashes(h, 0)
    names = np.zeros(n, np.uint64)
    ok = (which >= 0) & (best >= 0)
    names[ok] = mix(name[which[ok]] + _salt(1))
    names[own] = spans(own, own + window)
    at = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    size = np.diff(np.append(at, n))
    used = which[at] != -2
    at, size = at[used], size[used]
    return names[at], at, size, spans(at, at + size + window - 1)


def _cover(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the greatest k of the intervals [a[k], b[k]) over it, or -1.

    Each interval is two blocks of a power of two; blocks are then handed down
    to their halves.
    """
    length = b - a
    level = np.frexp(np.maximum(length, 1))[1] - 1
    above = None
    for k in range(int(level.max(initial=0)), -1, -1):
        here = np.full(n, -1, np.int64)
        own = np.flatnonzero((level == k) & (length > 0))
        here[a[own]] = own  # in rising order, so the greatest stays
        np.maximum.at(here, b[own] - (1 << k), own)
        if above is not None:
            np.maximum(here, above, out=here)
            half = 1 << k
            np.maximum(here[half:], above[:-half], out=here[half:])
        above = here
    return above


def _segments(batches: Iterator[pa.RecordBatch], window: int):
    """Word hashes of the texts of each batch in pieces of bounded size: (row, offset, hashes) lists."""
    for batch in batches:
        held, size = [], 0
        for row, text in enumerate(texts(batch.column("text"))):
            words = word_hashes(text)
            for at in range(0, max(1, len(words) - window + 1), SEGMENT):
                h = words[at : at + SEGMENT + window - 1]
                if len(h) < window:
                    continue
                held.append((row, at, h))
                size += len(h)
                if size >= SEGMENT:
                    yield batch, held
                    held, size = [], 0
        if held:
            yield batch, held


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _find_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in _segments(batches, window):
            lengths = np.array([len(h) for _, _, h in held])
            starts = np.cumsum(lengths) - lengths
            name, at, n, context = anchors(np.concatenate([h for _, _, h in held]), starts, window)
            piece = np.searchsorted(starts, at, side="right") - 1
            row, offset = (np.array([x[k] for x in held])[piece] for k in (0, 1))
            key, sig = (batch.column(c).take(pa.array(row)) for c in ("key", "sig"))
            s = at - starts[piece] + offset
            yield pa.record_batch(
                [_signed(name), _signed(context), key, sig, pa.array(s, pa.int32()), pa.array(n, pa.int32())],
                names=["name", "c", "key", "sig", "s", "n"],
            )

    return run


def _lists(batch: pa.RecordBatch):
    """Of each row a function that repeats its key, the text and the fields of its list of structs."""
    column = batch.column("list")
    for row, text in enumerate(texts(batch.column("text"))):
        found = column[row].values
        fields = {f.name: found.field(f.name).to_numpy(zero_copy_only=False) for f in found.type} if found is not None else {}
        own = [batch.column(c)[row] for c in ("key", "sig")]
        yield (lambda n, own=own: [pa.repeat(x, n) for x in own]), text, fields


def _windows(window: int):
    """Each window of each run of starts, as two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, f in _lists(batch):
                h = word_hashes(text)
                s = np.repeat(f["s"].astype(np.int64), f["n"]) + np.arange(f["n"].sum()) - np.repeat(np.cumsum(f["n"]) - f["n"], f["n"])
                s, at = np.unique(s, return_index=True)
                one = np.repeat(f["one"], f["n"])[at]
                s, one = s[fits := s + window <= len(h)], one[fits]
                if len(s):
                    yield pa.record_batch(
                        [*(_signed(span_hashes(h, w)(s, s + window)) for w in (0, 1)), *key(len(s)), pa.array(s.astype(np.int32)), pa.array(one)],
                        names=["h1", "h2", "key", "sig", "s", "one"],
                    )

    return run


def _cut(window: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digest, kept = [], [], [], []
            for _, text, f in _lists(batch):
                words = text.split()
                if len(f.get("s", ())):
                    edge = np.zeros(len(words) + 1, np.int64)
                    fits = f["s"] + f["n"] + window - 1 <= len(words)
                    np.add.at(edge, f["s"][fits], 1)
                    np.add.at(edge, (f["s"] + f["n"] + window - 1)[fits], -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                text = b" ".join(left)
                digest.append(hashlib.sha256(text).hexdigest())
                kept.append(text)
            cols = {"rest": batch.column("rest"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            cols["kept_sha256"] = pa.array(digest, pa.string())
            if keep:
                cols["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.record_batch(cols)

    return run


def cut_repeats(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, whole: bool = False
) -> DataFrame:
    """Remove each word that a repeated window of ``window`` words covers.

    Words are what ASCII white space separates.  Recompression gives each run
    of window starts an anchor symbol.  Anchors whose name is found once in the
    corpus belong to no repeat.  Of the others, whole contexts are compared
    first, by the name and a second hash: two equal ones settle all their
    windows at once, and one stands for all.  Only where a name has several
    contexts are single windows compared, by 128 bits.  Counts come from
    aggregations with partial sums and go back to the documents by joins that
    split hot keys; no group is ever collected.  Texts are shuffled once, by
    a digest of id and text, and that exchange is read three times.

    Returns one row per input row: the id, ``n_words``, ``n_removed``,
    ``kept_sha256`` and, with ``keep``, ``kept_text``; with ``whole`` the input's
    own columns with the kept words, joined by one space, as the text.  Null
    text has no words; texts of any length are read whole.  Rows that repeat an
    id or have none are documents of their own.  Rows that repeat id and text
    share one list of marks, so their number costs no more than their texts.
    An empty table gives an empty result; other columns, whatever their names,
    are ignored or, with ``whole``, pass through.
    """
    rows, (i, x) = numbered(docs, id_col, text_col)
    others = [c for c in rows.columns if c != x] if whole else [i]
    t = rows.select(
        F.struct(*others).alias("rest"),
        *(F.xxhash64(F.lit(salt), i, x).alias(c) for salt, c in enumerate(("key", "sig"))),  # 128 bits, as rows may repeat an id
        F.coalesce(x, F.lit("")).alias("text"),
    )
    row = ["key", "sig"]
    found = t.drop("rest").mapInArrow(_find_anchors(window), "name long, c long, key long, sig long, s int, n int")
    names = materialize(found.groupBy("name").agg(F.count("*").alias("k")).filter("k > 1").select("name"), "names")
    again = materialize(spread(found, names, ["name"], "left_semi"), "anchors")

    def listed(marks: DataFrame, *cols: str) -> DataFrame:
        return marks.groupBy(*row).agg(F.collect_set(F.struct(*cols)).alias("list"))  # a set: equal rows have equal marks

    classes = again.groupBy("name", "c").agg(F.count("*").alias("k"), F.min(F.struct("key", "sig", "s", "n")).alias("rep"))
    classes = materialize(classes, "contexts")
    settled = spread(again, classes.filter("k > 1").select("name", "c"), ["name", "c"], "left_semi").select("key", "sig", "s", "n")
    several = classes.groupBy("name").agg(F.count("*").alias("m")).filter("m > 1").select("name")
    open_ = spread(classes, several, ["name"], "left_semi").select("rep.*", (F.col("k") == 1).alias("one"))
    single = spread(t, listed(open_, "s", "n", "one"), row).mapInArrow(_windows(window), "h1 long, h2 long, key long, sig long, s int, one boolean")
    twice = single.groupBy("h1", "h2").agg(F.count("*").alias("k")).filter("k > 1").select("h1", "h2")
    verified = spread(single.filter("one"), twice, ["h1", "h2"], "left_semi").select("key", "sig", "s", F.lit(1).alias("n"))
    marks = listed(settled.unionByName(verified), "s", "n")
    keep = keep or whole
    fields = T.StructType([t.schema["rest"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")), T.StructField("kept_sha256", T.StringType())])
    out = spread(t, marks, row, "left").mapInArrow(_cut(window, keep), fields.add("kept_text", T.StringType()) if keep else fields)
    if whole:
        return out.select(*(F.col("kept_text" if c == x else f"rest.{c}") for c in rows.columns)).toDF(*docs.columns)
    return out.select(F.col("rest")[i].alias(id_col), *out.columns[1:])
