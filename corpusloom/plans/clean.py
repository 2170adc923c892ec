"""The clean stage: a document is dropped for the first reason that holds, in a fixed order; what is kept is normalised, deduplicated and redacted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions import filters, pii
from corpusloom.functions import text as tx
from corpusloom.functions.lineage import cut, fenced
from corpusloom.operators import decontam, dedup, provenance


def local_reasons(docs: DataFrame, s: Settings) -> DataFrame:
    """seq, source_url, lang, text (after line cleaning), drop_reason of the checks that look at one document.

    What is cheap comes first, and n-grams are counted only for documents that no cheaper check before them drops. Each step is fenced, as Spark would put
    the text's normalisation and the language's expression wherever the next steps name them, and evaluate them there each time."""
    c = s.clean
    rows = fenced(docs.withColumn("_norm", tx.normalize(F.coalesce("text", F.lit("")))))
    first = F.when(F.coalesce(tx.strip(F.col("text")), F.lit("")) == "", "no_text").when(F.coalesce("source_url", F.lit("")) == "", "no_source_url").when(F.col("_norm") == "", "empty_after_normalize")
    rows = fenced(rows.withColumns({"_r0": first, "_lang": filters.detect_language(F.col("_norm"))}))
    rows = fenced(rows.withColumn("_r1", F.coalesce("_r0", filters.language_reason(F.col("_lang.lang"), F.col("_lang.score"), c.lang_allow, c.lang_score_min))))
    rows = rows.withColumn("_grams", filters.ngram_chars(F.when(F.col("_r1").isNull(), F.col("_norm")).otherwise("")))
    rows = fenced(rows.withColumn("_c4", filters.c4_clean(F.col("_norm"))))
    # coalesce() leaves out what comes after the first reason; each reason stands in it once, or the plan would double with every step
    text = F.col("_c4.text")
    rows = rows.withColumn(
        "_r2", F.coalesce("_r1", filters.repetition_reason(F.col("_norm"), F.col("_grams")), filters.gopher_reason(F.col("_norm"), F.col("_lang.lang"), c.gopher_quality, c.vi_overrides),
            F.col("_c4.reason"), filters.shrunk_reason(text, c.gopher_quality.min_words), filters.list_like_reason(text)))
    return fenced(rows.select(*[x for x in docs.columns if x not in ("text", "lang", "drop_reason")], F.col("_lang.lang").alias("lang"), text.alias("text"), F.col("_r2").alias("drop_reason")))


def clean(docs: DataFrame, s: Settings | None = None, benchmark: DataFrame | None = None, scorer=None, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """docs: seq, text, source_url and optionally license, extractor, crawl_ts. Returns (clean records, status of every document: seq, drop_reason).

    scorer: DataFrame(seq, text) -> DataFrame(seq, quality), used where the quality classifier is enabled."""
    s = s or Settings()
    if s.clean.quality.enabled and scorer is None:
        raise ValueError("the quality classifier is enabled without a scorer")
    rows = cut(local_reasons(docs, s))
    alive = rows.filter("drop_reason IS NULL")
    first = cut(dedup.exact_duplicates(alive.select("seq", "text")).select("seq", (F.col("first_seq") < F.col("seq")).alias("exact")))
    unique = alive.join(first.filter("NOT exact").select("seq"), "seq")
    scoped = unique.select("seq", "text", dedup.scope_of(F.col("source_url"), s.clean.minhash.scope).alias("scope"))
    near = dedup.greedy_near_duplicates(scoped, s.clean.minhash, s.seed)
    later = F.when(F.col("exact"), "exact_dup").when(F.coalesce("is_dup", F.lit(False)), "minhash_dup")
    status = first.join(near, "seq", "left")
    passed = ["lid", "gopher", "c4", "fineweb", "dedup", "pii"]
    if benchmark is not None:
        met = decontam.hits(unique, benchmark, s.clean.decontam.ngram).select("seq", F.lit(True).alias("met"))
        status, later, passed = status.join(met, "seq", "left"), later.when(F.col("met"), "decontam"), [*passed, "decontam"]
    if s.clean.quality.enabled:
        scored = scorer(unique.select("seq", "text")).select("seq", "quality")
        status, later, passed = status.join(scored, "seq", "left"), later.when(F.col("quality") < s.clean.quality.min_score, "quality_score_low"), [*passed, "quality"]
    else:
        status = status.withColumn("quality", F.lit(None).cast("double"))
    late = cut(status.select("seq", "quality", later.alias("late")))
    kept = alive.join(late.filter("late IS NULL").select("seq", "quality"), "seq")
    red = pii.redact(F.col("text"), s.clean.pii.vi_regex)
    col = lambda c, default: F.col(c) if c in docs.columns else F.lit(default).cast("string")
    prov = provenance.make(F.col("source_url"), col("crawl_ts", None), F.coalesce(col("license", None), F.lit("unknown")), F.coalesce(col("extractor", None), F.lit("unknown")), s.pipeline_version, s.seed, passed, now if now is not None else F.current_timestamp())
    out = kept.withColumn("_pii", red).select("seq", tx.stable_id(dedup.content_hash(F.col("text"))).alias("id"), F.col("_pii.text").alias("text"), "lang", "quality", F.col("_pii.types").alias("pii_found"), prov.alias("prov"))
    every = rows.select("seq", "drop_reason").join(late.select("seq", "late"), "seq", "left").select("seq", F.coalesce("drop_reason", "late").alias("drop_reason"))
    return out, every
