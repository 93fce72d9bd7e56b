"""Language identification: held-out accuracy and edge cases."""

import random

import zstandard
from pyspark.sql import types as T

from tracklake.llm import language_id
from tracklake.llm.language_id import MARGIN, CompressionClassifier, identify, learn_dictionaries
from tracklake.llm.queries import op10_language_zstd

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op10_language_zstd(spark, SF)
    want = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(want, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert got.count() == want.count()


def test_edge_cases(spark):
    schema = T.StructType([T.StructField(c, k) for c, k in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("score", T.StringType()))])
    train = spark.createDataFrame(
        [(i, f"the cat and the dog number {i} went to the house with them", "en", None) for i in range(50)]
        + [(i, f"der hund und die katze nummer {i} gingen zu dem haus mit ihnen", "de", None) for i in range(50)]
        + [(1, None, "fr", None), (2, "text ohne sprache", None, None)],
        schema,
    )
    learned = learn_dictionaries(train)
    assert set(learned) == {"en", "de"}
    tests = spark.createDataFrame(
        [(1, "the dog and the cat", "x", None), (2, "der hund und die katze", "x", None), (3, None, None, None), (4, "12 !?", None, None), (4, "", None, None), (None, "the house " * 50_000, None, None)],
        schema,
    )
    got = sorted(identify(tests, learned, reject=False).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und", "en"]
    assert got[2].score == 0.0
    assert {r.lang_pred for r in identify(tests, {}).collect()} == {"und"}
    assert {r.lang_pred for r in identify(tests, learned, margin=1.1).collect()} == {"und"}
    assert identify(tests.limit(0), learned).collect() == []
    assert learn_dictionaries(train.limit(0)) == {}


def test_all_parts_of_a_long_text_count():
    rng = random.Random(5)
    words = {lang: ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(3000)] for lang in ("aa", "bb")}
    prose = lambda lang, n: " ".join(rng.choices(words[lang], k=n // 7)).encode()
    model = CompressionClassifier({lang: prose(lang, 31_000) for lang in words})
    for lang, other in (("aa", "bb"), ("bb", "aa")):
        assert model(prose(other, 300_000) + b" " + prose(lang, 900_000))[0] == lang
        short, long = model(prose(lang, 4_000)), model(prose(lang, 1_500_000))
        assert long[0] == lang and long[2] >= MARGIN
        assert long[1] > 0.9 * short[1] and long[2] > 0.8 * short[2]


def test_more_languages_than_a_task_keeps_coders_of(spark, monkeypatch):
    """All of 300 languages are learned and predicted, also those whose texts are all short or all long."""
    rng = random.Random(8)
    words = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(40)] for k in range(300)}
    prose = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    size = {"l000": 9000, "l001": 5}
    rows = [(100 * k + i, prose(lang, size.get(lang, 60)), lang) for k, lang in enumerate(words) for i in range(4)]
    monkeypatch.setattr(language_id, "TOTAL_BYTES", 300 * 1000)
    learned = learn_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert learned.keys() == words.keys() and all(0 < len(d) <= 1000 for d in learned.values())
    asked = spark.createDataFrame([(k, prose(lang, 300), lang) for k, lang in enumerate(words)], "doc_id long, text string, want string").repartition(8)
    got = {r.doc_id: r.lang_pred for r in identify(asked, learned, reject=False).collect()}
    assert sum(got[k] == lang for k, lang in enumerate(words)) > 290


def test_registered_query_is_the_plain_sum_of_block_sizes(spark):
    """Every prediction of the query against compressing each text's blocks one by one."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = learn_dictionaries(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    how = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_LAZY, min_match=4, window_log=18, hash_log=16, chain_log=16, search_log=4, write_content_size=False, write_checksum=False, write_dict_id=False)
    got = {r.doc_id: r for r in op10_language_zstd(spark, sf).collect()}
    for r in docs.collect():
        data = (r.text or "").lower().encode()
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        n = -(-len(data) // 4000)
        step = -(-len(data) // n)
        total = {}
        for lang, d in learned.items():
            coder = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            total[lang] = sum(len(coder.compress(data[i : i + step])) for i in range(0, len(data), step))
        best = min(total.values())
        assert got[r.doc_id].lang_pred == min(k for k, v in total.items() if v == best)
        assert abs(got[r.doc_id].score - 1 / sum(min(1.0, 2.0 ** ((best - v) * 64 / best)) for v in total.values())) < 1e-12


def test_odd_names(spark):
    df = spark.createDataFrame([(1, "the house and the garden", "en", "a", True, 1.0)], "`doc.id` long, `te``xt` string, lang string, share string, whole boolean, o double")
    learned = learn_dictionaries(df, "te`xt", "lang", "doc.id")
    assert [tuple(r) for r in identify(df, learned, id_col="doc.id", text_col="te`xt", reject=False).collect()] == [(1, "en", 1.0, True)]
