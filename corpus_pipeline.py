"""The corpus pipeline: quality rules, near-duplicates, mixing and encoding of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import mixing, quality_rules, sentencepiece_codec, similar
from corpusloom.llm.common import stored
from corpusloom.llm.queries import PIECES, table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or a certified cutoff rejects go."""
    return quality_rules.kept_rows(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; a group is linked by a similarity of 0.8 or more of five-word shingles.

    Pairs to be compared come from SimHash fingerprints within 5 bits, by pigeonring; those that are similar but further apart come from the shingles, so that none is lost."""
    return similar.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target asks for."""
    return mixing.mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the ids of its pieces."""
    return sentencepiece_codec.encode_documents(docs, tokenizer_path(PIECES))


STAGES = [("quality rules", quality), ("simhash near-dedup", near_dedup), ("mixing to target weights", mix), ("sentencepiece encoding", encode)]
#: Fingerprints and pieces can't be had in SQL; tests/llm/test_pipeline.py holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
