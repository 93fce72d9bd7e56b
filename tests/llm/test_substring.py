"""Removal of repeated windows against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.llm import substring_dedup
from tracklake.llm.substring_dedup import anchors, cut_repeats

DOCS = T.StructType([T.StructField(c, k) for c, k in (("doc_id", T.LongType()), ("text", T.StringType()), ("name", T.StringType()), ("key", T.StringType()))])


def brute(rows, window):
    words = [[w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w] for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(400)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([20, 34, 35, 36, 60, 90]))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 34, 35, 80, 300]))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            p = rng.choice(passages)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[rng.choice([0, 0, 5]) :]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    base = [rng.choice(vocab) for _ in range(200)]
    for i in range(30):  # near copies
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(200)] = rng.choice(vocab)
        rows.append((200 + i, " ".join(own)))
    rows += [(300, "hot " * 36), (301, "hot " * 35), (302, "hot " * 400), (303, "ha ho " * 60), (304, "x ha ho " * 40), (305, None), (306, ""), (307, rows[3][1])]
    rows += [(400, " ".join(base)), (400, " ".join(base)), (None, "only " + " ".join(map(str, range(50)))), (None, " ".join(base[:40])), (400, " ".join(vocab[:100]))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [200_000, 50])
def test_against_brute_force(spark, segment, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SEGMENT", segment)
    rows = corpus(segment)
    df = spark.createDataFrame([(*r, None, None) for r in rows], DOCS).repartition(5)
    got = cut_repeats(df, keep=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows, 35)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    for vocab in (2, 5, 1000):
        words = rng.integers(1, vocab + 1, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        words = np.concatenate((words, words[500:700], words[:100], words[1000:1035]))
        starts = np.array([0, 1000, 3000, 3200, 3210])
        name, at, n, _ = anchors(words, starts, 35)
        own = {int(a) + k: int(x) for x, a, m in zip(name, at, n) for k in range(m)}
        ends = [*starts[1:], len(words)]
        assert sorted(own) == [s for a, b in zip(starts, ends) for s in range(a, b - 34)]
        by = {}
        for s, x in own.items():
            assert by.setdefault(words[s : s + 35].tobytes(), x) == x


def test_empty(spark):
    assert cut_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_rows_without_an_id_whose_texts_share_a_short_hash(spark):
    """Both texts have the same 32-bit hash; only the first holds a repeat."""
    first, other = (" ".join(f"w{i}_{k}" for k in range(1, 51)) for i in (97217, 233648))
    again = " ".join(first.split()[:40])
    docs = spark.createDataFrame([(None, first), (None, other), (1, again)], "doc_id long, text string")
    assert docs.filter("doc_id IS NULL").select(F.hash("text")).distinct().count() == 1
    got = cut_repeats(docs, window=35, keep=True).collect()
    assert sorted(r.kept_text for r in got) == sorted(("", " ".join(first.split()[40:]), other))


def test_many_equal_rows_cost_no_more_than_their_texts(spark):
    """100,000 rows without an id and with one text, as a table that repeats rows has them."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows = rows.union(spark.createDataFrame([(1, text[:-4]), (2, "own words")], "doc_id long, text string"))
    got = cut_repeats(rows, window=35).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 60, 60, 100_000), (1, 59, 59, 1), (2, 2, 0, 1)], key=str)


def test_text_ids_and_odd_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([("a", text, 1, "x", "y"), ("b", text + " end", 2, "x", "y")], "`id.x` string, `te``xt` string, `key` int, `_k` string, kept_text string")
    got = sorted(map(tuple, cut_repeats(df, id_col="id.x", text_col="te`xt", whole=True).collect()))
    assert got == [("a", "", 1, "x", "y"), ("b", "end", 2, "x", "y")]
