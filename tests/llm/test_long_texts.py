"""Texts of ten million characters through the operators that go through whole texts."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import chat_format, lm_scoring, sentencepiece_codec, simhash, similar, token_counts, warc

UNIT = "the quick brown fox jumps over 13 lazy dogs, and <b>é</b> "
LONG = UNIT * (10_000_000 // len(UNIT))


@pytest.fixture(scope="module")
def docs(spark):
    one = spark.createDataFrame([(UNIT,)], "unit string")
    return one.select(F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("doc_id"), F.lit(n).alias("n")) for i, n in ((1, len(LONG) // len(UNIT)), (2, 1))])).alias("d"), "unit").select("d.doc_id", F.expr("repeat(unit, d.n)").alias("text"))


def test_token_counts(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    unit = len(Tokenizer.from_file(path).encode(f" {UNIT[:-1]}", add_special_tokens=False).ids)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, path).collect()}
    assert got[1].n_bytes == len(LONG.encode()) and abs(got[1].n_tokens - unit * (len(LONG) // len(UNIT))) <= 2


def test_fingerprints_and_sets(docs):
    assert {r.doc_id for r in simhash.near_duplicates(docs).collect()} == {1, 2}
    assert {(r.doc_id, r.component_id) for r in similar.near_duplicates(docs).collect()} == {(1, 1), (2, 2)}


def test_chat(spark, docs):
    turns = docs.filter("doc_id = 1").select(F.lit(7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), "text")
    r = chat_format.digest(chat_format.expand(turns)).first()
    assert r.loss_chars == len(LONG) and r.loss_sha256 == hashlib.sha256(LONG.encode()).hexdigest()


def test_archives(docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x.example/").alias("url"), F.col("text").alias("html"))
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert got[1].payload_bytes == len(LONG.encode()) and got[1].payload_digest == hashlib.sha1(LONG.encode()).hexdigest()


def test_pieces(docs):
    got = {r.doc_id: r for r in sentencepiece_codec.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("ids").collect()}
    assert all(r.lossless for r in got.values()) and got[1].n_bytes == len(LONG.encode())


def test_scores(docs):
    got = {r.doc_id: r for r in lm_scoring.score(docs, vocabulary_size=20).collect()}
    assert got[1].n_tokens == len(LONG.split()) + 1 and got[1].score > got[1].base_score
