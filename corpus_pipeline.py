"""The corpus pipeline: documents in, packed sequences out.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir), works
on all rows that the stage before it kept, and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``docs``, also such as clash with names that operators
use.  Nulls in any column, empty tables and repeated rows are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import exact_dedup, simhash, substring_dedup, toxicity
from tracklake.llm.common import discard, materialize, table, written
from tracklake.llm.packing import pack
from tracklake.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; all others stay as they are."""
    return toxicity.drop_rejected(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (five words, a similarity of 0.8) the row with the smallest id stays."""
    return simhash.near_dedup(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a repeated window of 35 words go; the rest is joined by one space, and ``n_chars`` follows."""
    cut = substring_dedup.cut_repeats(docs, window=35, whole=True)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", cut_passages),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; the last one's rows.

    What a stage has written goes once the next one's output is there.
    """
    docs = table(spark, sf_dir, "documents")
    first = len(written)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, written[first:-1])
        first = len(written) - 1
    return STAGES[-1][1](spark, docs, sf_dir)
