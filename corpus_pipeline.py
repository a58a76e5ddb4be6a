"""A training corpus from ``documents``, in five stages: toxicity, exact dedup, near dedup, mixing and packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitals.llm import exact_dedup, ngram_join, packing, source_mix, toxicity
from vitals.llm.common import outside, scratch
from vitals.llm.queries import table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-duplicate links make stays: five-word shingles, similarity from 0.8."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them; the one that a budget ends in is kept whole."""
    return source_mix.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in windows; a document that the mix repeats is packed as often."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_windows),
]

#: A trained classifier and a tokenizer are in it; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # what the stage wrote on its way goes
            docs = outside(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
