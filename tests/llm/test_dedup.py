"""Exact and near deduplication against brute force."""

import hashlib
import random

import xxhash
from pyspark.sql import types as T

from tracklake.llm.components import connected_components
from tracklake.llm.exact_dedup import _chains, content_sort_dedup, drop_copies
from tracklake.llm.simhash import near_dedup, near_fingerprints, simhash_components

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("keep_id", T.StringType()),
    ]
)


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], DOCS)


def test_exact_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["", None, "a", "b", "ab", "é", "long " * 9000, f"own {i}", "hot", "hot", "hot"])) for i in range(3000)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in content_sort_dedup(docs(spark, rows).repartition(7)).collect()}
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    for text, ids in groups.items():
        for i in ids:
            want = (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == want


def test_exact_edge_cases(spark):
    assert content_sort_dedup(docs(spark, [])).collect() == []
    got = content_sort_dedup(docs(spark, [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b")])).collect()
    assert sum(r.kept for r in got) == 2
    assert {r.keep_id for r in got if r.group_size == 3} == {1}
    assert {r.keep_id for r in got if r.group_size == 2} == {None}


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_against_brute_force(spark):
    rng = random.Random(2)
    words = [f"W{i}é" for i in range(300)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 4, 60, 300]))]
        for _ in range(rng.choice([1, 1, 5])):
            own = list(base)
            own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\n\t"]).join(own)))
    rows += [(len(rows), None), (len(rows) + 1, " \n"), (len(rows) + 2, "x " * 20_000), (len(rows) + 3, " a b\x1cc d")]
    got = {r.doc_id: r for r in simhash_components(docs(spark, rows)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == want


def test_simhash_edge_cases(spark):
    assert simhash_components(docs(spark, [])).collect() == []
    got = simhash_components(docs(spark, [(None, "a b"), (5, "a b"), (5, "a b"), (None, "some other words here")])).collect()
    assert sorted((r.component_id is None, r.component_id) for r in got) == [(False, 5)] * 3 + [(True, None)]


def test_tiles_lose_no_link(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(200)]
    for _ in range(600):
        fps.append(rng.choice(fps) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1))
    signed = sorted({f - 2**64 if f >> 63 else f for f in fps})
    import tracklake.llm.simhash as simhash

    old, simhash.TILE = simhash.TILE, 32
    try:
        links = near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 4)
        got = {r.u: r.root for r in connected_components(links).collect()}
    finally:
        simhash.TILE = old
    want = brute_components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {n: got.get(n, n) for n in signed} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (700, 600), (600, 700)], "u long, v long")
    got = {r.u: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {700: 600}
    assert connected_components(edges.limit(0)).collect() == []


def test_whole_rows_stay(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, "", "a b", f"text {i % 40}", "hot"])) for i in range(2000)] + [(None, "a b"), (None, "only here")]
    df = docs(spark, rows).repartition(9)
    got = drop_copies(df).collect()
    best: dict = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in got) == sorted(best.items())
    assert got[0].asDict().keys() == {"doc_id", "text", "fp", "keep_id"} and got[0].fp == "x"
    once = near_dedup(docs(spark, [(3, "a b"), (2, "A b"), (9, "other words"), (None, "a  b"), (None, "alone now here")]))
    assert sorted((r.doc_id is None, r.text) for r in once.collect()) == [(False, "A b"), (False, "other words"), (True, "alone now here")]
    assert drop_copies(docs(spark, [])).collect() == [] and near_dedup(docs(spark, [])).collect() == []


def test_runs_at_borders_are_compared_in_full(spark):
    """Runs in the order of partitions: only equal neighbours, across empty partitions too, are one group."""
    rows = [(0, 0, "a"), (0, 1, "b"), (2, 0, "b"), (3, 0, "b"), (3, 1, "c"), (4, 0, "d"), (4, 1, "c"), (5, 0, "c")]
    got = _chains(spark.createDataFrame(rows, "pid int, run int, text string"))
    assert [got[p, r] for p, r, _ in rows] == [1, 2, 2, 2, 3, 4, 5, 5]
    assert _chains(spark.createDataFrame([], "pid int, run int, text string")) == {}


def test_whole_rows_with_odd_names(spark):
    cols = "doc_id long, `te.xt` string, `_text` string, `_id` string, `_sha` string, `pid` int, `run` int, `d``x` string"
    rows = [(i, t, f"t{i}", f"i{i}", "s", i, None, "d") for i, t in ((1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"))]
    df = spark.createDataFrame(rows, cols)
    out = drop_copies(df, text_col="te.xt")
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [rows[1], rows[3], rows[4]]
    near = near_dedup(df, text_col="te.xt")
    assert near.columns == df.columns and sorted(r[0] for r in near.collect()) == [1, 3, 5]


def test_wide_fingerprints_against_brute_force(spark):
    """Links of 256 bits: all of those that two texts have, found over tiles; the first 64 bits are the narrow fingerprint."""
    import tracklake.llm.simhash as simhash

    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 80, 200]))]
        for _ in range(rng.choice([1, 4])):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    rows = list(enumerate(dict.fromkeys([*texts, "", " ", "x " * 9000])))
    wide = {i: simhash.wide_fingerprint(t.encode(), 5, 4) for i, t in rows}
    assert all(int(wide[i][0]) == simhash.fingerprint(t.encode(), 5) for i, t in rows)

    def linked(a, b):
        apart = [(int(x) ^ int(y)).bit_count() for x, y in zip(wide[a], wide[b], strict=True)]
        return apart[0] <= 16 and sum(apart) <= 46

    want = brute_components([i for i, _ in rows], linked)
    old, simhash.TILE = simhash.TILE, 32
    try:
        kept = near_dedup(docs(spark, rows)).collect()
    finally:
        simhash.TILE = old
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values())) and len(kept) < len(rows)


def test_near_dedup_goes_by_similarity():
    """Texts with most five-word shingles in common are linked, texts with half of them are not."""
    import numpy as np

    from tracklake.llm.simhash import wide_fingerprint

    rng, near, far = random.Random(5), 0, 0
    for _ in range(100):
        base = [str(rng.randrange(5000)) for _ in range(300)]
        for changes, half in ((4, False), (20, True)):
            other = list(base)
            for k in range(changes):
                other[(k * 300 // changes) + 7] = "other"
            a, b = (wide_fingerprint(" ".join(t).encode(), 5, 4) for t in (base, other))
            apart = np.bitwise_count(a ^ b)
            linked = bool(apart[0] <= 16 and apart.sum() <= 46)
            near, far = near + (linked and not half), far + (linked and half)
    assert near >= 97 and far <= 1  # similarities of 0.87 and 0.5
