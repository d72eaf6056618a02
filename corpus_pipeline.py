"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``, extra ones included; each works on all that
the one before kept.

1. ``quality``: documents that the rule ensemble scores below its threshold go.
2. ``exact_dedup``: of documents equal but for white space, one stays.
3. ``near_dedup``: of each group linked by shingles of five words at a
   similarity of 0.8 or more, the document with the smallest id stays.
4. ``mix_sources``: every source is taken up to its target; a document that is
   taken twice comes as two rows.
5. ``pack_sequences``: a row per piece of at most 1024 tokens and its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketpulse.llm.common import stored, table
from marketpulse.llm.exact_dedup import drop_exact_copies
from marketpulse.llm.mixing import mix
from marketpulse.llm.near_dedup import one_of_each
from marketpulse.llm.packing import packed
from marketpulse.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The first stage learns its rules, which SQL can't express; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
