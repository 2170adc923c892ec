import importlib
import json
from dataclasses import replace

import helpers as h
import pytest
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.operators import quality_model, sft
from corpusloom.plans import clean, extract, integrate
from corpusloom.sources import records
from corpusloom.streaming import clean_stream

S = Settings()
URL = "https://h.example/"


def now():
    return F.lit("2026-01-01").cast("timestamp")


def raw(spark, rows):
    return spark.createDataFrame(rows, "seq long, text string, source_url string, license string")


def test_clean_stage(spark):
    rows = [(1, h.EN, URL, "cc-by"), (2, h.VI, URL, None), (3, h.EN + "  ", "https://other.example/", None), (4, "too short", URL, None), (5, h.EN, None, None), (6, None, URL, None), (7, "​ \x00", URL, None), (8, h.EN.replace("bread", "cake"), URL, None), (9, h.EN.replace("bread", "cake"), "https://far.example/", None)]
    out, status = clean.clean(raw(spark, rows), S, now=now())
    reasons = {r.seq: r.drop_reason for r in status.collect()}
    assert reasons == {1: None, 2: None, 3: "exact_dup", 4: reasons[4], 5: "no_source_url", 6: "no_text", 7: "empty_after_normalize", 8: "minhash_dup", 9: "exact_dup"}
    assert reasons[4].startswith("gopher_word_count")
    kept = {r.seq: r for r in out.collect()}
    assert set(kept) == {1, 2} and kept[2].lang == "vi" and kept[1].prov.license == "cc-by" and kept[1].prov.is_publishable and not kept[2].prov.is_publishable
    assert records.drop_counts(status)["kept"] == 2 and sum(records.drop_counts(status)["dropped"].values()) == 7


def test_personal_data_goes_last_and_benchmarks_count(spark):
    mail = h.EN + " Write to a.b@c.example."
    quiz = " ".join(h.EN.split()[:20])
    out, status = clean.clean(raw(spark, [(1, mail, URL, None)]), S, now=now())
    r = out.first()
    assert "[EMAIL]" in r.text and r.pii_found == ["email"] and "decontam" not in r.prov.filters_passed
    import hashlib

    assert r.id == hashlib.sha256(hashlib.sha256(mail.encode()).hexdigest().encode() + b"\x1f").hexdigest()[:16]
    _, status = clean.clean(raw(spark, [(1, mail, URL, None)]), S, spark.createDataFrame([(quiz,)], "text string"), now=now())
    assert status.first().drop_reason == "decontam"


def test_classifier_is_pluggable_and_never_silently_absent(spark):
    s = replace(S, clean=replace(S.clean, quality=replace(S.clean.quality, enabled=True)))
    with pytest.raises(ValueError):
        clean.clean(raw(spark, []), s)
    scorer = lambda d: d.select("seq", F.when(F.col("seq") == 1, 0.9).otherwise(0.2).alias("quality"))
    out, status = clean.clean(raw(spark, [(1, h.EN, URL, None), (2, h.VI, URL, None)]), s, scorer=scorer, now=now())
    assert {r.seq: r.drop_reason for r in status.collect()} == {1: None, 2: "quality_score_low"} and out.first().quality == 0.9


def test_empty_inputs(spark, tmp_path):
    out, status = clean.clean(raw(spark, []), S, spark.createDataFrame([], "text string"), now=now())
    assert out.count() == status.count() == 0
    none = records.read_jsonl(spark, f"file://{tmp_path}/missing", "text string")
    assert none.count() == 0 and none.columns == ["text", "bad_json"]


def test_extract_stage(spark):
    page = "<title>T</title><p>Body text under CC BY 4.0</p>"
    rows = [("u1", page, None, None, None), (None, page, None, None, None), ("u3", " ", None, None, None), ("u4", "<nav>x</nav>", None, None, None), ("u5", None, "unknown", "application/pdf", None), ("u6", page, "unknown", None, None), ("u7", None, None, None, "f.pdf")]
    df = spark.createDataFrame(rows, "source_url string, html string, license string, content_type string, pdf_path string")
    got = {r.source_url: r for r in extract.extract(df, pdf=lambda c: F.when(c == "f.pdf", "pdf text")).collect()}
    assert {k: r.drop_reason for k, r in got.items()} == {"u1": None, None: "no_source_url", "u3": "no_content", "u4": "empty_extract_html", "u5": "pdf_no_path", "u6": None, "u7": None}
    assert (got["u1"].license, got["u6"].license, got["u1"].title, got["u7"].text) == ("cc-by", "unknown", "T", "pdf text")


def test_integrate_prefers_the_better_source(spark):
    rows = [(1, h.EN, "en", "crawl_new"), (2, h.EN + " More.", "en", "curated_v2"), (3, h.VI, "vi", "crawl_new"), (4, "short english words of the other kind " * 30, "en", "crawl_new")]
    df = spark.createDataFrame(rows, "seq long, text string, lang string, _source string")
    out, manifest = integrate.integrate(df, S)
    ids = {r.seq for r in out.collect()}
    assert 2 in ids and 1 not in ids and 3 in ids
    assert {r.lang for r in manifest.collect()} == {"en", "vi"}
    off, _ = integrate.integrate(df, replace(S, integrate=replace(S.integrate, cross_dedup=False)))
    assert 1 in {r.seq for r in off.collect()}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "b").mkdir(parents=True)
    (tmp_path / "in/a.jsonl").write_text('{"text": "one", "n": 1}\n\n{"text": broken\n')
    (tmp_path / "in/b/c.jsonl").write_text('{"text": "two"}\n')
    got = records.read_jsonl(spark, f"file://{tmp_path}/in", "text string, n long").collect()
    assert sorted((r.text or "", r.bad_json) for r in got) == [("", True), ("one", False), ("two", False)]
    with pytest.raises(Exception):  # noqa: B017
        records.read_jsonl(spark, f"file://{tmp_path}/in", "text string", strict=True).collect()
    (tmp_path / "html").mkdir()
    (tmp_path / "html/p.html").write_text("<p>x</p>")
    assert records.read_html(spark, f"file://{tmp_path}/html").first().source_url.endswith("/p.html")
    (tmp_path / "html/p.meta.json").write_text(json.dumps({"source_url": "https://s.example", "license": "cc0"}))
    r = records.read_html(spark, f"file://{tmp_path}/html").first()
    assert (r.source_url, r.license, r.html) == ("https://s.example", "cc0", "<p>x</p>")
    out = f"file://{tmp_path}/out"
    records.write_jsonl(spark.createDataFrame([("é", None)], "text string, n long"), out)
    assert not records.is_done(spark, out, "abc")
    records.write_manifest(spark, out, {"config": "abc", "seen": 1})
    assert records.is_done(spark, out, "abc") and not records.is_done(spark, out, "other")
    assert records.config_hash(S) == records.config_hash(Settings()) != records.config_hash(replace(S, seed=1))


def test_stream_gives_the_batch_result(spark, tmp_path):
    rows = [(1, h.EN, URL), (2, h.VI, URL), (3, "short", URL), (4, h.EN, URL)]
    df = spark.createDataFrame(rows, "seq long, text string, source_url string")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    clean_stream.run_available(clean_stream.clean_stream(stream), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect()) in ([1, 2], [2, 4])


def test_checks_of_a_document_are_computed_once(spark):
    df = raw(spark, [(1, h.EN, URL, None)])
    for rows in (clean.local_reasons(df, S), clean.local_reasons(df, S).filter("drop_reason IS NULL")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("[ \\t]+") == plan.count("ArrowEvalPython [_nfc") == plan.count("ArrowEvalPython [_ngram_chars") == plan.count("[^a-z]+") == 1


def test_the_fit_reads_ids_in_one_task_and_no_texts(spark, monkeypatch):
    d = spark.createDataFrame([(i, f"word{i % 2} and word{i % 5}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, None if i == 9 else i % 2) for i in range(0, 200)], "doc_id long, quality int")
    cuts, cut = [], quality_model.cut
    monkeypatch.setattr(quality_model, "cut", lambda x: cuts.append(cut(x)) or cuts[-1])
    model = quality_model.fit_quality(d, labels, 20)
    assert [x.columns for x in cuts] == [["doc_id"], ["label", "features"]] and [x.count() for x in cuts] == [20, 20]
    first = [r.doc_id for r in d.filter("doc_id <> 9").orderBy(F.xxhash64("doc_id")).limit(20).collect()]
    assert [r.label for r in cuts[1].collect()] == [i % 2 for i in first]
    assert {r.doc_id for r in quality_model.score_quality(model, d).collect()} == set(range(60))


def test_trained_scorers(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality_model.score_quality(quality_model.fit_quality(d, labels), d).withColumnRenamed("quality", "score").join(labels, "doc_id")
    mean = {r.quality: r.m for r in scored.groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert mean[1] > mean[0] + 0.1
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    odd = e.select("vec_id", "embedding").limit(3).withColumn("embedding", F.when(F.col("vec_id") % 2 == 0, F.transform("embedding", lambda x: x * F.lit(float("nan"))))).withColumn("vec_id", -1 - F.col("vec_id"))
    got = {r.vec_id: r.cluster for r in quality_model.clusters(e.select("vec_id", "embedding").unionByName(odd), k=3, fit_rows=100).collect()}
    assert len(got) == e.count() + 3  # all of them, though 100 are fitted on
    assert {c for v, c in got.items() if v >= 0} == {0, 1, 2} and {c for v, c in got.items() if v < 0} == {None}
    assert [r.cluster for r in quality_model.clusters(e.limit(4)).collect()] == [None] * 4


def test_registered_queries_run_without_the_subpackage():
    entry = importlib.import_module("__spark_entry__")
    from corpusloom.plans import oracles, queries

    assert set(queries.QUERIES) <= set(entry.queries()) and set(oracles.SQL) <= set(queries.QUERIES)


def test_conversation_messages_are_in_order(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert [tuple(m) for m in sft.conversations(df).first().messages] == [("user", "a"), ("assistant", "b")]
