"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, chat_format, lm_scoring, mixing, quality_rules, sentencepiece_codec, simhash, token_counts, url_filters, warc

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counts = quality_rules.text_counts(docs)
    counts = quality_rules.cut(counts.withColumn("_row", F.struct("_row.doc_id", "_row.lang")))
    cutoffs = quality_rules.certified_cutoffs(counts, table(spark, sf_dir, "labels"))
    out = quality_rules.judge(counts, quality_rules.cut(cutoffs))
    return out.select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return chat_format.digest(chat_format.expand(turns.unionByName(own)))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_quality_rules": op3_quality_rules,
        "op4_simhash": op4_simhash,
        "op5_mixing": op5_mixing,
        "op6_chat_format": op6_chat_format,
        "op7_url_filters": op7_url_filters,
        "op8_neighbours": op8_neighbours,
        "op9_warc": op9_warc,
        "op10_sentencepiece": op10_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    from corpusloom.llm import oracles

    return oracles.SQL
