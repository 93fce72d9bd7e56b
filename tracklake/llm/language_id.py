"""Language identification by compression with dictionaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, texts

#: Bytes of a language's dictionary and of all dictionaries together; beyond
#: TOTAL_BYTES / DICT_BYTES languages each one's dictionary is smaller, so every
#: language has one and what a task holds is bounded.
DICT_BYTES, TOTAL_BYTES = 32_000, 64 << 20
#: Bytes of the texts that go into a dictionary whole, and letters of a slice of a longer one.
LEAST_BYTES, MOST_BYTES, SLICE = 200, 8_000, 2_000
#: Coders that a task keeps at a time; more languages than that take turns.
CODERS = 256
#: A text is compressed in equal blocks of at most this size: far below the coder's window, so every byte can refer to the dictionary.
BLOCK_BYTES = 4_000
#: A result counts as sure from this share between the best two sizes on.
MARGIN = 0.01

_LETTER = regex.compile(r"\p{L}")


def learn_dictionaries(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, bytes]:
    """Raw-content dictionaries from a bounded sample of labelled rows.

    For each language, whole texts of ``LEAST_BYTES`` to ``MOST_BYTES`` in the
    order of a hash of id and text, until the dictionary is full; where there
    are none, other texts, of longer ones a slice that the hash places.  The
    sample of all languages is drawn in one pass, by a threshold on the hash
    and a running sum of bytes, so what reaches the driver is bounded by the
    dictionaries.  Rows without text or language teach nothing; a language all
    of whose texts are empty is not learned.
    """
    text, size = F.col("text"), F.octet_length("text")
    rows = docs.select(column(text_col).alias("text"), column(lang_col).cast("string").alias("lang"), F.xxhash64(column(id_col), column(text_col)).alias("o"))
    rows = rows.filter((size > 0) & F.col("lang").isNotNull())
    fit = size.between(LEAST_BYTES, MOST_BYTES)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(fit).alias("fit")).collect()  # one row for each language
    if not counts:
        return {}
    full = min(DICT_BYTES, TOTAL_BYTES // len(counts))
    want = max(1, DICT_BYTES // LEAST_BYTES)
    shares = [(r.lang, min(1.0, 4.0 * want / (r.fit or r.n)), r.fit > 0) for r in counts]
    plan = docs.sparkSession.createDataFrame(shares, "lang string, share double, whole boolean")
    few = rows.join(F.broadcast(plan), "lang").filter((F.pmod("o", F.lit(1 << 30)) / float(1 << 30) <= F.col("share")) & (fit | ~F.col("whole")))
    long = size > MOST_BYTES
    at = F.pmod(F.shiftright("o", 30), F.greatest(F.lit(1), F.char_length("text") - SLICE + 1)) + 1
    few = few.select("lang", "o", F.lower(F.when(long, F.substr("text", at.cast("int"), F.lit(SLICE))).otherwise(text)).alias("t"))
    first = Window.partitionBy("lang").orderBy("o", "t").rowsBetween(Window.unboundedPreceding, -1)  # over the sample alone
    few = few.withColumn("before", F.coalesce(F.sum(F.octet_length("t")).over(first), F.lit(0))).filter(F.col("before") < full)
    out: dict[str, bytes] = {}
    for row in sorted(few.collect(), key=lambda r: (r.lang, r.before, r.o, r.t)):
        if len(found := out.get(row.lang, b"")) < full:
            out[row.lang] = (found + row.t.encode() + b"\n")[:full]
    return out


class CompressionClassifier:
    """Compresses all blocks of a text with each language's dictionary; the smallest sum wins.

    Each block meets the dictionary afresh, so all parts of a text count alike
    and shares of the sums do not fall with the number of blocks.
    """

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        z = zstandard
        how = z.ZstdCompressionParameters(
            strategy=z.STRATEGY_LAZY, min_match=4, window_log=18, hash_log=16, chain_log=16, search_log=4,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.parts = sorted(dictionaries.items())
        self.coder = lambda d: z.ZstdCompressor(compression_params=how, dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT))
        self.ready = [(lang, self.coder(d)) for lang, d in self.parts] if len(self.parts) <= CODERS else None

    def coders(self) -> Iterator[tuple[str, zstandard.ZstdCompressor]]:
        """Each language with its coder; where there are many, a coder lives for one text only."""
        return iter(self.ready) if self.ready is not None else ((lang, self.coder(d)) for lang, d in self.parts)

    def __call__(self, text: bytes) -> tuple[str, float, float]:
        """The language, a score from 0 to 1, and the margin to the next in parts of its size."""
        text = text.decode("utf-8", "replace")
        if not self.parts or not _LETTER.search(text):
            return "und", 0.0, 0.0
        data = text.lower().encode()
        step = -(-len(data) // -(-len(data) // BLOCK_BYTES))
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.coders())
        best, lang = sizes[0]
        if len(sizes) == 1:
            return lang, 1.0, 1.0
        margin = (sizes[1][0] - best) / sizes[1][0]
        score = 1.0 / sum(min(1.0, 2.0 ** ((best - s) * 64.0 / best)) for s, _ in sizes)
        return lang, score, margin


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], extra: dict[str, Column] | None = None,
    id_col: str = "doc_id", text_col: str = "text", reject: bool = True, margin: float = MARGIN,
) -> DataFrame:
    """Predict the language of every whole text, without a shuffle.

    Returns one row per input row: the id, the columns ``extra``, ``lang_pred``,
    ``score`` and ``sure`` (the margin is not narrow).  A text that is null or
    has no letter is ``und``, score 0; with ``reject`` so is one whose margin is
    narrow.  Ties go to the first language by name.  Without dictionaries all
    texts are ``und``.  Repeated rows are judged each; an empty table gives an
    empty result; other columns, whatever their names, are ignored.
    """
    extra = extra or {}
    base = docs.select(column(text_col), column(id_col), *(c.alias(k) for k, c in extra.items()))
    names = [*base.columns[1:], "lang_pred", "score", "sure"]
    base = base.toDF("text", *(f"c{k}" for k in range(len(names) - 3)))
    fields = [*base.schema.fields[1:], *(T.StructField(n, t) for n, t in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("sure", T.BooleanType())))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = CompressionClassifier(dictionaries)
        for batch in batches:
            found = [model(t) for t in texts(batch.column(0))]
            sure = [f[2] >= margin for f in found]
            lang = [f[0] if s or not reject else "und" for f, s in zip(found, sure, strict=True)]
            new = [pa.array(lang, pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(sure, pa.bool_())]
            yield pa.record_batch([*batch.columns[1:], *new], names=[f.name for f in fields])

    return base.mapInArrow(run, T.StructType(fields)).toDF(*names)
