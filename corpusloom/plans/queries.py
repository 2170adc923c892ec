"""Registered queries of the curation operators, each over whole tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions import filters, html, licence, pii
from corpusloom.functions import text as tx
from corpusloom.functions.lineage import cut, ensure_checkpoint_dir
from corpusloom.operators import crawl, decontam, dedup, mix, profile, provenance, quality_model, sft
from corpusloom.plans import clean as clean_plan
from corpusloom.plans import extract as extract_plan
from corpusloom.plans import integrate as integrate_plan
from corpusloom.sources import records
from corpusloom.streaming import clean_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
S = Settings()
RATIOS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
LICENCES = ("cc-by", "cc0", "unknown", "cc-by-sa")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in fewer parts than there are cores (a small one, in one file) is dealt out to all."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, text, source, source_url."""
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))
    return d.select(F.col("doc_id").alias("seq"), "doc_id", "text", "source", F.col("lang").alias("doc_lang"), url.alias("source_url"))


def long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


@query
def word_stats(spark, sf_dir):
    w = tx.let(tx.words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), tx.total_length(w).alias("c")))
    d = documents(spark, sf_dir).select("doc_id", w.alias("w"), F.size(tx.lines(F.col("text"))).alias("l"))
    return d.select("doc_id", long("w.n").alias("n_words"), long("w.c").alias("n_word_chars"), long("l").alias("n_lines"))


@query
def normalize_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.normalize(F.col("text")).alias("text"))


@query
def stable_ids(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.stable_id(F.col("source_url"), F.lit(html.FALLBACK)).alias("id"), tx.stable_id(dedup.content_hash(F.col("text"))).alias("content_id"))


@query
def url_hosts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.url_host(F.col("url")).alias("host"))


@query
def lang_detect(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", filters.detect_language(F.col("text")).alias("x"))
    return d.select("doc_id", "x.lang", "x.score")


@query
def lang_gate(spark, sf_dir):
    c = S.clean
    return lang_detect(spark, sf_dir).select("doc_id", filters.language_reason(F.col("lang"), F.col("score"), c.lang_allow, c.lang_score_min).alias("reason"))


@query
def gopher_quality_reason(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("x", filters.detect_language(F.col("text")))
    return d.select("doc_id", filters.gopher_reason(F.col("text"), F.col("x.lang"), S.clean.gopher_quality, S.clean.vi_overrides).alias("reason"))


def _dups(d: DataFrame, parts) -> DataFrame:
    return d.select("doc_id", filters.duplicate_parts(parts).alias("x")).select("doc_id", *[long(f"x.{c}").alias(c) for c in ("n", "dups", "chars", "dup_chars")])


@query
def dup_line_frac(spark, sf_dir):
    return _dups(documents(spark, sf_dir), tx.lines(F.col("text")))


@query
def dup_para_frac(spark, sf_dir):
    return _dups(documents(spark, sf_dir), tx.paragraphs(F.col("text")))


def _grams(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", filters.ngram_chars(F.col("text")).alias("x"))


@query
def top_ngram_frac(spark, sf_dir):
    return _grams(spark, sf_dir).select("doc_id", *[f"x.top_{n}" for n in filters.TOP_CAPS])


@query
def dup_ngram_frac(spark, sf_dir):
    return _grams(spark, sf_dir).select("doc_id", "x.chars", *[f"x.dup_{n}" for n in filters.DUP_CAPS])


@query
def repetition_reason(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("g", filters.ngram_chars(F.col("text")))
    return d.select("doc_id", filters.repetition_reason(F.col("text"), F.col("g")).alias("reason"))


@query
def c4_clean(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", filters.c4_clean(F.col("text")).alias("x")).select("doc_id", "x.text", "x.reason")


@query
def c4_shrunk(spark, sf_dir):
    return c4_clean(spark, sf_dir).select("doc_id", filters.shrunk_reason(F.col("text"), S.clean.gopher_quality.min_words).alias("reason"))


@query
def list_like(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", filters.list_like_reason(F.col("text")).alias("reason"))


@query
def exact_dup(spark, sf_dir):
    return dedup.exact_duplicates(documents(spark, sf_dir).select("seq", "text")).select(F.col("seq").alias("doc_id"), "first_seq", (F.col("first_seq") < F.col("seq")).alias("is_dup"))


@query
def minhash_greedy(spark, sf_dir):
    """Scopes are languages here, as near copies in the tables cross sources."""
    d = documents(spark, sf_dir).select("seq", "text", F.col("doc_lang").alias("scope"))
    return dedup.greedy_near_duplicates(d, S.clean.minhash, S.seed).withColumnRenamed("seq", "doc_id")


@query
def cross_dedup_components(spark, sf_dir):
    return dedup.near_components(documents(spark, sf_dir), S.clean.minhash, S.seed).withColumnRenamed("seq", "doc_id")


@query
def cross_dedup_keep(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("_source", F.when(F.col("seq") % 2 == 0, "crawl_new").otherwise("curated_v2"))
    return dedup.cross_keep(d, S.clean.minhash, S.integrate.source_priority, S.seed).withColumnRenamed("seq", "doc_id")


@query
def decontam_hits(spark, sf_dir):
    found = decontam.hits(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), S.clean.decontam.ngram)
    return found.select(F.col("seq").alias("doc_id"), "n_hits")


@query
def pii_types(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", pii.redact(F.col("text"))["types"].alias("t"))
    return d.select("doc_id", F.array_join("t", ",").alias("types"))


@query
def pii_redact(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", pii.redact(F.col("text"))["text"].alias("text"))


def _clean(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return clean_plan.clean(documents(spark, sf_dir).select("seq", "text", "source_url"), S, table(spark, sf_dir, "benchmark"), now=F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query
def clean_status(spark, sf_dir):
    return _clean(spark, sf_dir)[1].select(F.col("seq").alias("doc_id"), "drop_reason")


@query
def clean_funnel(spark, sf_dir):
    kind = F.coalesce(filters.reason_kind(F.col("drop_reason")), F.lit("kept"))
    return _clean(spark, sf_dir)[1].groupBy(kind.alias("reason")).agg(F.count("*").alias("n"))


@query
def clean_docs(spark, sf_dir):
    out = _clean(spark, sf_dir)[0]
    return out.select(F.col("seq").alias("doc_id"), "id", "text", "lang", F.array_join("pii_found", ",").alias("pii_found"), F.col("prov.license").alias("license"), F.col("prov.is_publishable").alias("is_publishable"), F.array_join("prov.filters_passed", ",").alias("filters_passed"))


@query
def provenance_problems(spark, sf_dir):
    d = documents(spark, sf_dir)
    tag = F.get(F.array(*[F.lit(x) for x in (*LICENCES, "other")]), (F.col("seq") % 5).cast("int"))
    prov = provenance.make(F.when(F.col("seq") % 7 != 0, F.col("source_url")), F.lit("2026-01-02T03:04:05Z"), tag, F.lit("x"), S.pipeline_version, S.seed, ["lid"], F.lit("2026-01-01").cast("timestamp"))
    out = provenance.problems(d.select("doc_id", prov.alias("prov")))
    return out.select("doc_id", "problem", F.col("prov.license").alias("license"), F.col("prov.is_publishable").alias("is_publishable"))


def _facts(spark, sf_dir) -> DataFrame:
    d = documents(spark, sf_dir)
    tag = F.get(F.array(*[F.lit(x) for x in LICENCES]), (F.col("seq") % 4).cast("int"))
    return profile.facts(d.select("seq", "text", F.col("doc_lang").alias("lang"), "source_url", tag.alias("license"), pii.redact(F.col("text"))["types"].alias("pii_found")))


@query
def profile_lang(spark, sf_dir):
    return profile.counts(_facts(spark, sf_dir), "lang")


@query
def profile_distributions(spark, sf_dir):
    return profile.distributions(_facts(spark, sf_dir))


@query
def profile_length_hist(spark, sf_dir):
    return _facts(spark, sf_dir).groupBy(profile.bucket(F.col("n_words")).alias("bucket")).agg(F.count("*").alias("n"))


@query
def profile_length_stats(spark, sf_dir):
    f = profile.length_stats(_facts(spark, sf_dir))
    return f.select("n_docs", long("min_words").alias("min_words"), long("max_words").alias("max_words"), "mean_words", "median_words", "near_empty")


@query
def profile_domain_top50(spark, sf_dir):
    return profile.top_hosts(_facts(spark, sf_dir))


@query
def profile_pii(spark, sf_dir):
    return profile.pii_counts(_facts(spark, sf_dir))


@query
def profile_suggestions(spark, sf_dir):
    return profile.suggestions(_facts(spark, sf_dir))


def _sized(spark, sf_dir) -> DataFrame:
    return cut(documents(spark, sf_dir).select("seq", F.col("doc_lang").alias("lang"), mix.token_count(F.col("text")).alias("tokens")))


@query
def mix_budget(spark, sf_dir):
    return mix.budgets(_sized(spark, sf_dir), RATIOS)


@query
def mix_selected(spark, sf_dir):
    return mix.select(_sized(spark, sf_dir), RATIOS).select(F.col("seq").alias("doc_id"), "lang", "tokens", "used_before")


@query
def mix_manifest(spark, sf_dir):
    return mix.manifest(mix.select(_sized(spark, sf_dir), RATIOS), RATIOS)


@query
def integrate(spark, sf_dir):
    d = documents(spark, sf_dir)
    both = records.label_sources(d.filter("seq % 2 = 1"), d.filter("seq % 2 = 0"), S.integrate.source_priority).withColumnRenamed("doc_lang", "lang")
    out, _ = integrate_plan.integrate(both, replace(S, integrate=replace(S.integrate, mix_ratios=RATIOS)))
    return out.select("doc_id", "lang", "_source")


@query
def html_extract(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source_url"), "html")
    return extract_plan.extract(raw).select("page_id", "id", "text", "title", "license", "extractor", "drop_reason")


@query
def html_license(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", licence.detect(F.col("html")).alias("license"))


@query
def html_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.posexplode(html.links(F.col("html"), F.col("url"))).alias("pos", "link")).select("page_id", long("pos").alias("pos"), "link")


@query
def html_render_mode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.render_mode(F.col("html")).alias("render"), html.needs_render(F.col("html")).alias("needs_render"))


@query
def html_feeds(spark, sf_dir):
    """The pages have no feeds; one is put behind every page to have something to find."""
    more = F.concat("html", F.lit('<link rel="alternate" type="application/rss+xml" href="/feed/'), F.col("page_id").cast("string"), F.lit('.xml">'))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(html.feeds(more)).alias("feed"))


@query
def robots_rules(spark, sf_dir):
    """Rules written from the pages' ids."""
    lines = F.concat(F.lit("User-agent: *\nDisallow: /en/\n# Disallow: /no\nCrawl-delay: "), F.col("page_id").cast("string"), F.lit("\nDisallow:\nCrawl-delay: soon\nSitemap: "), "url")
    p = table(spark, sf_dir, "pages").select("page_id", "url", crawl.parse_robots(lines).alias("r"))
    may = crawl.allowed(F.col("url"), F.col("r.disallow"))
    return p.select("page_id", F.col("r.crawl_delay").alias("crawl_delay"), crawl.delay_of(F.col("r.crawl_delay"), S.crawl).alias("delay"), F.array_join("r.sitemaps", " ").alias("sitemaps"), F.array_join("r.disallow", " ").alias("disallow"), may.alias("allowed"))


@query
def sitemap_urls(spark, sf_dir):
    xml = F.concat(F.lit("<urlset><url><loc> "), "url", F.lit("</loc></url><url><loc>"), tx.url_host(F.col("url")), F.lit("</loc></url></urlset>"))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(crawl.parse_sitemap(xml)).alias("pos", "loc")).select("page_id", long("pos").alias("pos"), "loc")


@query
def source_profiles(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", "html", F.lit("Crawl-delay: 2\nDisallow: /x").alias("robots"), F.create_map(F.lit("content-type"), F.lit("text/html")).alias("headers"), F.lit("<loc>https://a.example/</loc>").alias("sitemap"))
    out = crawl.source_profile(p)
    return out.select("url", "render", "crawl_delay", "license", "content_type", F.array_join("seed_urls", " ").alias("seed_urls"), F.array_join("disallow", " ").alias("disallow"), "fetched")


@query
def crawl_frontier(spark, sf_dir):
    """Two hosts made of the pages' ids: of every 64 pages the first is a seed, and page j of them links to 4j + 1 to 4j + 4. Small caps, which both take effect."""
    at = lambda c: F.concat(F.lit("https://"), F.when(F.floor(c / 64) % 2 == 0, "site").otherwise("other"), F.lit(".example/"), (c % 20).cast("string"), F.lit("/"), c.cast("string"))
    k = F.col("page_id")
    near = F.filter(F.array(*[k % 64 * 4 + n for n in range(1, 5)]), lambda j: j < 64)
    more = F.array_join(F.transform(near, lambda j: F.concat(F.lit('<a href="'), at(k - k % 64 + j), F.lit('">x</a>'))), '<a href="mailto:x">z</a>')
    site = table(spark, sf_dir, "pages").select("page_id", at(k).alias("url"), more.alias("html"))
    rules = spark.sql("SELECT 'site.example' AS host, array('/7/') AS disallow")
    return crawl.crawl(site.drop("page_id"), site.filter(k % 64 == 0).select("url"), replace(S.crawl, max_depth=6, url_exclude=["/5/"], per_host_concurrency=2, max_pages=150), rules)


def _chats(spark, sf_dir) -> DataFrame:
    chats = sft.conversations(table(spark, sf_dir, "conversations"))
    tag = F.get(F.array(*[F.lit(x) for x in LICENCES]), (F.col("conv_id") % 4).cast("int"))
    prov = F.when(F.col("conv_id") % 11 != 0, F.struct(tag.alias("license"), F.concat(F.lit("https://c.example/"), F.col("conv_id").cast("string")).alias("source_url")))
    return chats.select("conv_id", tx.stable_id(F.col("conv_id").cast("string")).alias("id"), F.lit("en").alias("lang"), "messages", prov.alias("prov"))


@query
def sft_gate(spark, sf_dir):
    return sft.gate(_chats(spark, sf_dir)).select("conv_id", "drop_reason")


def _record(spark, sf_dir, fmt: str) -> DataFrame:
    kept = sft.gate(_chats(spark, sf_dir)).filter("drop_reason IS NULL")
    return sft.serialize(kept, fmt)


@query
def sft_chatml(spark, sf_dir):
    x = F.from_json("record", f"messages {sft.MESSAGES}, meta struct<license:string>")
    return _record(spark, sf_dir, "chatml").select("id", F.posexplode(x["messages"]).alias("pos", "m")).select("id", long("pos").alias("pos"), "m.role", "m.content")


@query
def sft_sharegpt(spark, sf_dir):
    x = F.from_json("record", "conversations array<struct<from:string,value:string>>")
    return _record(spark, sf_dir, "sharegpt").select("id", F.posexplode(x["conversations"]).alias("pos", "m")).select("id", long("pos").alias("pos"), F.col("m.from").alias("speaker"), F.col("m.value").alias("value"))


@query
def sft_alpaca(spark, sf_dir):
    x = F.from_json("record", "instruction string, input string, output string, meta struct<id:string,license:string,is_publishable:boolean>")
    d = _record(spark, sf_dir, "alpaca").select("id", x.alias("x"))
    return d.select("id", "x.instruction", "x.input", "x.output", F.col("x.meta.license").alias("license"), F.col("x.meta.is_publishable").alias("is_publishable"))


def _stub(messages: list[dict]) -> str:
    text = messages[1]["content"]
    return "Here: " + json.dumps({"pairs": [{"question": f"How long is it? {len(text)}", "answer": text[:20] or "empty"}, {"question": " ", "answer": "dropped"}]})


@query
def synth_qa(spark, sf_dir):
    d = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    return sft.synthesize(d, _stub, "stub", max_chars=None).select("id", long("n").alias("n"), "question", "drop_reason", "synth_id")


@query
def jsonl_round_trip(spark, sf_dir):
    """Documents as JSON lines, written to the shared folder and read with their schema."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/jsonl-{uuid.uuid4().hex}"
    records.write_jsonl(table(spark, sf_dir, "documents"), path)
    return records.read_jsonl(spark, path, "doc_id long, text string, lang string, source string, n_chars long")


@query
def stream_clean(spark, sf_dir):
    """The checks of single documents over a stream of the documents' files."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "documents").schema
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    d = rows.parquet(_as_folder(spark, sf_dir, base)).select(F.col("doc_id").alias("seq"), "text", F.concat(F.lit("https://"), "source", F.lit(".example/")).alias("source_url"))
    clean_stream.run_available(clean_stream.clean_stream(d), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").groupBy("content_hash").agg(F.count("*").alias("n"))


def _as_folder(spark, sf_dir: str, base: str) -> str:
    """Streams read folders: the table as one."""
    table(spark, sf_dir, "documents").write.parquet(f"{base}/in")
    return f"{base}/in"


@query
def quality_classifier(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit_quality(d, table(spark, sf_dir, "labels"))
    return quality_model.score_quality(model, d, S.clean.quality.min_score)


@query
def embedding_clusters(spark, sf_dir):
    return quality_model.clusters(table(spark, sf_dir, "embeddings"))
