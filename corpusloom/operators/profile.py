"""Profile of a clean dataset: counts, lengths, and suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

# Buckets of word counts.
BUCKETS = (("[0,50)", 50), ("[50,200)", 200), ("[200,1000)", 1000), ("[1000,5000)", 5000))
LAST_BUCKET = "5000+"
NEAR_EMPTY = 50


def bucket(n: Column) -> Column:
    out = F.when(n < BUCKETS[0][1], BUCKETS[0][0])
    for name, end in BUCKETS[1:]:
        out = out.when(n < end, name)
    return out.otherwise(LAST_BUCKET)


def facts(clean: DataFrame, seq: str = "seq") -> DataFrame:
    """What the profile needs of each record: seq, lang, licence, host, n_words, pii."""
    cols = set(clean.columns)
    col = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in cols else F.lit(default)
    host = tx.url_host(col("source_url", ""))
    pii = F.col("pii_found") if "pii_found" in cols else F.array().cast("array<string>")
    return clean.select(F.col(seq).alias("seq"), col("lang", "und").alias("lang"), col("license", "unknown").alias("license"), F.when(host == "", "?").otherwise(host).alias("host"), F.size(tx.words(F.coalesce("text", F.lit("")))).alias("n_words"), pii.alias("pii"))


def distributions(f: DataFrame) -> DataFrame:
    """metric, key, n of language, licence, host and length bucket, in one pass."""
    rows = f.withColumn("bucket", bucket(F.col("n_words")))
    sets = rows.groupingSets([["lang"], ["license"], ["host"], ["bucket"]], "lang", "license", "host", "bucket").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    metric = F.when(F.col("g") == 7, "lang").when(F.col("g") == 11, "license").when(F.col("g") == 13, "host").otherwise("length")
    return sets.select(metric.alias("metric"), F.coalesce("lang", "license", "host", "bucket").alias("key"), "n")


def counts(f: DataFrame, by: str) -> DataFrame:
    return f.groupBy(by).agg(F.count("*").alias("n"))


def top_hosts(f: DataFrame, k: int = 50) -> DataFrame:
    """The k most frequent hosts, of equals those seen first."""
    return f.groupBy("host").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq")).orderBy(F.desc("n"), "first_seq").limit(k)


def length_stats(f: DataFrame) -> DataFrame:
    """One row; none for no records."""
    return f.agg(F.count("*").alias("n_docs"), F.min("n_words").alias("min_words"), F.max("n_words").alias("max_words"), F.round(F.avg("n_words"), 1).alias("mean_words"), F.median("n_words").alias("median_words"), F.count_if(F.col("n_words") < NEAR_EMPTY).alias("near_empty")).filter("n_docs > 0")


def pii_counts(f: DataFrame) -> DataFrame:
    return f.select(F.explode("pii").alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def suggestions(f: DataFrame) -> DataFrame:
    """kind, key, n of what a person should look at: a host or a language with over 0.8 of all, unknown licences, over 0.3 of near-empty texts."""
    whole = f.agg(F.count("*").alias("docs"), F.count_if(F.col("n_words") < NEAR_EMPTY).alias("near_empty"), F.count_if(F.col("license") == "unknown").alias("unknown"), F.approx_count_distinct("lang").alias("langs"))
    tall = f.select(F.explode(F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("key")), F.struct(F.lit("lang").alias("kind"), F.col("lang").alias("key")))).alias("x")).groupBy("x.kind", "x.key").agg(F.count("*").alias("n"))
    skew = tall.join(F.broadcast(whole), F.col("n") > 0.8 * F.col("docs")).filter("kind = 'host' OR n < docs").select("kind", "key", "n")
    rest = whole.select(F.explode(F.array(F.struct(F.lit("license").alias("kind"), F.lit("unknown").alias("key"), F.col("unknown").alias("n"), (F.col("unknown") > 0).alias("ok")), F.struct(F.lit("near_empty").alias("kind"), F.lit("").alias("key"), F.col("near_empty").alias("n"), (F.col("near_empty") > 0.3 * F.col("docs")).alias("ok")))).alias("x")).filter("x.ok").select("x.kind", "x.key", "x.n")
    return skew.unionByName(rest)
