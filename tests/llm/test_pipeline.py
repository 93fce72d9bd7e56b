"""Each stage of the corpus pipeline against a plain version on its own input."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tracklake.llm import toxicity
from tracklake.llm.common import materialize, table, written

from .test_dedup import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_names_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "substring dedup", "packing"]
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in outputs[0].schema]


def test_toxic_documents_go(spark, outputs):
    model = toxicity.train(outputs[0], table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score(outputs[0], model).filter("rejected").collect()}
    assert bad
    assert rows(outputs[1]) == sorted((tuple(r) for r in outputs[0].collect() if r.doc_id not in bad), key=str)
    known = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    assert sum(known.get(i) == 0 for i in bad) == 0


def test_one_of_each_text_stays(outputs):
    best = {}
    for r in outputs[1].collect():
        if r.text not in best or r.doc_id > best[r.text].doc_id:
            best[r.text] = r
    assert rows(outputs[2]) == sorted(map(tuple, best.values()), key=str)


def brute_wide(text):
    """256 bits of SimHash over five words, the first 64 lowest, bit by bit."""
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    ones = [0] * 256
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(4):
            x = h
            if k:
                x = (h + k * 0x9E3779B97F4A7C15) % 2**64
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
                x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
                x ^= x >> 31
            for bit in range(64):
                ones[64 * k + bit] += x >> bit & 1
    return sum(1 << bit for bit, n in enumerate(ones) if 2 * n > len(shingles))


def test_one_of_each_component_stays(outputs):
    docs = outputs[2].collect()
    fps = {r.doc_id: brute_wide(r.text) for r in docs}
    first = {i: f & (2**64 - 1) for i, f in fps.items()}
    root = brute_components(sorted(fps), lambda a, b: (first[a] ^ first[b]).bit_count() <= 16 and (fps[a] ^ fps[b]).bit_count() <= 46)
    assert rows(outputs[3]) == sorted((tuple(r) for r in docs if root[r.doc_id] == r.doc_id), key=str)


def test_repeated_windows_go(outputs):
    docs = {r.doc_id: r for r in outputs[3].collect()}
    words = {i: [w.decode() for w in r.text.encode().split()] for i, r in docs.items()}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    got = {r.doc_id: r for r in outputs[4].collect()}
    assert got.keys() == docs.keys()
    for i, w in words.items():
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        assert got[i].text == " ".join(x for k, x in enumerate(w) if k not in gone)
        assert got[i].n_chars == len(got[i].text) and got[i].lang == docs[i].lang


def test_every_kept_document_is_packed(spark, outputs):
    packed = outputs[5].collect()
    whole = Counter()
    for r in packed:
        whole[r.doc_id] += r.length
    assert whole.keys() == {r.doc_id for r in outputs[4].collect()}
    assert all(whole[r.doc_id] == r.doc_tokens for r in packed)
    run = corpus_pipeline.run(spark, SF)
    digest = lambda df: hashlib.sha256(str(sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())).encode()).hexdigest()
    assert digest(run) == digest(outputs[5])


def test_edge_cases(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (2, "", None, None, 0), (3, "word " * 60_000, "en", None, 1)], docs.schema)
    for start, n in ((docs.limit(0), 0), (odd, 3)):
        df = start
        for name, stage in corpus_pipeline.STAGES:
            df = materialize(stage(spark, df, SF), name.replace(" ", "-"))
        assert df.select("doc_id").distinct().count() == n


def test_columns_with_names_that_operators_use(spark):
    """Each stage keeps such columns, their order and their values."""
    names = ["rejected", "severity", "_text", "_id", "_sha", "_key", "_k", "_edge", "_y", "key", "sig", "rest", "kept_text", "id", "y", "fp", "digest", "pid", "run", "c0", "n_words", "a.b", "c`d"]
    docs = table(spark, SF, "documents").filter("doc_id < 60")
    wide = docs.select("*", *(F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES:
        got = materialize(stage(spark, wide, SF), name.replace(" ", "-"))
        if name != "packing":
            assert got.columns == wide.columns
            plain = materialize(stage(spark, docs, SF), "plain")
            cols = [F.col("`" + n.replace("`", "``") + "`") for n in names]
            assert rows(got.select(docs.columns)) == rows(plain)
            assert all(r[k] == f"{n}-{r.doc_id}" for r in got.select("doc_id", *cols).collect() for k, n in enumerate(names, 1))


def test_what_stages_wrote_goes(spark):
    first = len(written)
    assert corpus_pipeline.run(spark, SF).count()
    from pathlib import Path

    left = [p for p in written[first:] if Path(p.removeprefix("file:")).exists()]
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left] == ["substring-dedup", "tokens", "lengths"]
