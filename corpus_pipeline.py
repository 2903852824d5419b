"""From raw documents to token ids: five stages, each on all that the stage
before it kept. A stage takes (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontaminate, langid, neardup, pieces, toxicity
from marquee.llm.frames import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; the others go."""
    return langid.accepted(docs)


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    return neardup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document left, decoded again as a check."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("toxicity", nontoxic),
    ("near_duplicates", distinct),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: Learned models, sketches and alignments are not SQL; tests/llm holds the
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
