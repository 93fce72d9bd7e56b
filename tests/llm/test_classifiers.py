"""Toxicity and quality: held-out figures and edge cases."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklake.llm import quality, toxicity
from tracklake.llm.queries import op3_toxicity_ordinal, op5_quality_cotraining

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def halves(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return docs, labels.filter(half), labels.filter(~half)


def test_toxicity_held_out(halves):
    docs, own, rest = halves
    rows = toxicity.score(docs, toxicity.train(docs, own)).join(rest, "doc_id").collect()
    toxic = [r.rejected for r in rows if r.toxic == 1]
    clean = [r.rejected for r in rows if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.85
    assert sum(clean) / len(clean) < 0.01
    assert all(0 <= r.severity <= 3 and 0 <= r.p_toxic <= 1 for r in rows)


def test_ordinal_fit_recovers_order_and_shared_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    eta = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=4000)
    y = (eta[:, None] > np.array([-1.0, 0.5, 2.0])).sum(axis=1)
    w, theta = toxicity.fit_ordinal(x, y, 4, penalty=0)
    assert np.abs(w - [2, -1, 0]).max() < 0.2 and np.abs(theta - [-1, 0.5, 2]).max() < 0.2


def test_quality_held_out(halves):
    docs, own, rest = halves
    rows = quality.score(docs, quality.train(docs, own)).join(rest.withColumnRenamed("quality", "label"), "doc_id").collect()
    good = [r.kept for r in rows if r.label == 1]
    bad = [r.kept for r in rows if r.label == 0]
    assert sum(good) / len(good) > 0.995
    assert sum(bad) / len(bad) < 0.05


def test_views_teach_each_other():
    """With few labels the pool must help: the metadata view sees what the content view is sure of."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 3000)
    a = np.column_stack((np.ones(3000), 3 * y - 1.5 + rng.normal(size=3000) * 0.7))
    b = np.column_stack((np.ones(3000), 3 * y - 1.5 + rng.normal(size=3000) * 0.7))
    known = np.full(3000, -1)
    known[:60] = y[:60]
    p = quality.co_train(a, b, known).probabilities(a, b)[2]
    assert ((p > 0.5) == y).mean() > 0.97


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, quality string, severity string"
    rows = [(1, None, None, None, "x", None), (1, "", "en", "s", None, None), (None, "some words\nhere", None, "s", None, None), (2, "word " * 60_000, "xx", None, None, None), (3, "\n\n", None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 1), (2, 1, 1), (77, 0, 0)], "doc_id long, quality int, toxic int")
    for part in (toxicity, quality):
        for known in (labels, labels.limit(0)):
            got = part.score(docs, part.train(docs, known)).collect()
            assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert part.score(docs.limit(0), part.train(docs.limit(0), labels)).collect() == []
    both = spark.createDataFrame([(2, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, both)).count() == len(rows)
    assert quality.score(docs.drop("lang", "source"), quality.train(docs, both)).count() == len(rows)


def test_views_learn_from_all_rows_without_a_label(spark):
    """A source that only the last ids by hash have still reaches the metadata view."""
    ids = [r[0] for r in spark.range(6_600).orderBy(F.xxhash64("id"), "id").collect()]
    prose, junk = "The house stands near the river and the people walk along it every day.", "$$$ 777 ### WIN %% 999 @@ " * 4
    label = {i: k % 2 for k, i in enumerate(ids[:200])}
    rows = [(i, f"{prose} It is number {i}." if label.get(i, k % 3 > 0) else f"{junk}{i}", "en", f"s{k % 2}") for k, i in enumerate(ids[:6_400])]
    rows += [(i, f"{junk} {i} $$$ ### %%%", "en", "rare") for i in ids[6_400:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = quality.train(docs, spark.createDataFrame(list(label.items()), "doc_id long, quality int"))
    rare = quality.metadata_features(b"", None, "rare") - quality.metadata_features(b"", None, None)
    assert not any(rare @ quality.metadata_features(b"", "en", s) for s in ("s0", "s1"))
    assert model.metadata @ rare < 0


def test_registered_toxicity_is_the_plain_model(spark):
    """Every row of the query against the fitted model applied word by word."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in op3_toxicity_ordinal(spark, sf).collect()}
    at = {f: k for k, f in enumerate(model.features)}
    n = len(at)
    assert n and len(got) == docs.count()
    for r in docs.collect():
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        count = dict.fromkeys(range(n), 0)
        for w in words:
            for f in {w} | ({w[:4] + "*"} if len(w) > 4 else set()) | ({w[:5] + "*"} if len(w) > 5 else set()):
                if f in at:
                    count[at[f]] += 1
        z = sum(model.weights[k] * math.log(1 + c) + model.weights[n + k] * math.log(1 + 100 * c / len(words)) for k, c in count.items() if c)
        p = [1 / (1 + math.exp(t - z)) for t in model.thresholds]
        assert abs(got[r.doc_id].severity - sum(p)) < 1e-9 and abs(got[r.doc_id].p_toxic - p[0]) < 1e-9
        assert got[r.doc_id].rejected == (p[0] >= toxicity.REJECT)
        steps = [a - b for a, b in zip([1, *p], [*p, 0])]
        assert steps[got[r.doc_id].grade] > max(steps) - 1e-9


def test_registered_quality_is_the_plain_model(spark):
    """Every row of the query against the fitted views applied to one text at a time."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in op5_quality_cotraining(spark, sf).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        text = (r.text or "").encode()
        za = model.scale[0, 0] * float(quality.content_features(text) @ model.content) + model.scale[0, 1]
        zb = model.scale[1, 0] * float(quality.metadata_features(text, r.lang, r.source) @ model.metadata) + model.scale[1, 1]
        both = model.scale[2, 0] * za + model.scale[2, 1] * zb + model.scale[2, 2]
        assert abs(got[r.doc_id].quality - 1 / (1 + math.exp(-max(-30, min(30, both))))) < 1e-9
        assert got[r.doc_id].kept == (got[r.doc_id].quality >= quality.KEEP)


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    seen = []
    fit = toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, *a: seen.append(len(x)) or fit(x, *a))
    rows = [(1, f"vile words {i % 7}") for i in range(3000)] + [(i, "good plain words here") for i in range(2, 40)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, y string, `id` string")
    labels = spark.createDataFrame([(i, int(i == 1), int(i > 1)) for i in range(1, 40)], "doc_id long, toxic int, quality int")
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == len(rows) and seen == [39]
    assert quality.score(docs, quality.train(docs, labels)).count() == len(rows)
