import random
from dataclasses import replace

import helpers as h
import pytest
from pyspark.sql import functions as F

from corpusloom.config import DatasetPlan, Integrate, MinHash, Settings, apply_plan, from_dict, load
from corpusloom.functions import minhash
from corpusloom.operators import crawl, decontam, dedup, graph, mix, profile, sft
from corpusloom.operators.graph import components

S = Settings()


def bands_of(text, cfg=MinHash(), seed=42):
    a, b = minhash.coefficients(cfg.num_hashes, seed)
    sig = minhash.signature(minhash.shingles(text, cfg.ngram), a, b)
    return None if sig is None else [(k, tuple(sig[k * cfg.rows : (k + 1) * cfg.rows])) for k in range(cfg.bands)]


def chain_texts():
    """Texts that drift word by word: neighbours are near, ends are not."""
    rng = random.Random(4)
    w = [f"w{rng.randrange(1000)}" for _ in range(120)]
    out = []
    for i in range(12):
        w[rng.randrange(len(w))] = f"n{i}"
        out.append(" ".join(w))
    return [*out, "", "!!!", "one two three", "One, two three", h.EN, h.EN]


def test_signatures_are_minima_of_the_exact_hashes():
    a, b = minhash.coefficients(112, 42)
    s = minhash.shingles(h.EN, 5)
    want = [min((int(x) * int(v) + int(y)) % ((1 << 61) - 1) for v in s) for x, y in zip(a, b, strict=True)]
    assert list(map(int, minhash.signature(s, a, b))) == want
    assert minhash.signature(minhash.shingles("?", 5), a, b) is None
    assert list(minhash.signature(s, *minhash.coefficients(112, 7))) != want


def test_near_duplicates_in_a_scope_and_across(spark):
    rows = [(i, t, "abc"[i % 3 % 2]) for i, t in enumerate(chain_texts())]
    df = spark.createDataFrame(rows, "seq long, text string, scope string").repartition(3)
    want = {}
    for scope in "ab":
        want |= h.greedy([(i, bands_of(t)) for i, t, s in rows if s == scope])
    assert {r.seq: r.is_dup for r in dedup.greedy_near_duplicates(df, S.clean.minhash).collect()} == want
    assert 0 < sum(want.values()) < len(want)
    comp = h.classes([(i, bands_of(t)) for i, t, _ in rows])
    assert {r.seq: r.component for r in dedup.near_components(df, S.clean.minhash).collect()} == comp
    best = {}
    for i, _, s in rows:
        best[comp[i]] = min(best.get(comp[i], (9, 9)), ({"b": 0}.get(s, 1), i))
    got = {r.seq: r.kept for r in dedup.cross_keep(df.withColumn("_source", F.col("scope")), S.clean.minhash, ["b"]).collect()}
    assert got == {i: best[comp[i]][1] == i for i, _, _ in rows}


def test_near_duplicates_of_the_small_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("seq"), "text", F.lit("x").alias("scope"))
    bands = [(r.seq, bands_of(r.text)) for r in d.orderBy("seq").collect()]
    assert {r.seq: r.is_dup for r in dedup.greedy_near_duplicates(d, S.clean.minhash).collect()} == h.greedy(bands)
    assert {r.seq: r.component for r in dedup.near_components(d, S.clean.minhash).collect()} == h.classes(bands)


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1000, 1100)] + [(5, i) for i in range(6, 200)] + [(rng.randrange(300, 700), rng.randrange(300, 700)) for _ in range(250)] + [(8, 8)]
    rng.shuffle(edges)
    want = h.classes([(n, [e for e in edges if n in e]) for n in sorted({x for e in edges for x in e})])
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_frequent_values_are_salted(spark, monkeypatch):
    parents = spark.range(100).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("up"))
    assert graph._salted(parents, F.array(F.lit(7), F.lit(8)).cast("array<long>")).count() == 98 + 2 * graph.SALTS
    assert graph._salted(parents, F.array().cast("array<long>")).count() == 100
    monkeypatch.setattr(graph, "HEAVY", 20)
    edges = [(5, i) for i in range(6, 200)] + [(300, i) for i in range(301, 400)] + [(i, i + 1) for i in range(500, 530)]
    want = {n: min(x for x in (5, 300, 500) if x <= n and n - x < 200) for e in edges for n in e}
    want |= {n: 5 for n in range(5, 200)}
    assert {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def test_copies_bring_their_bands_once(spark, monkeypatch):
    rows = [(i, h.EN if i % 3 else h.EN + f" Word{i % 2}.") for i in range(40)] + [(50, ""), (51, None)]
    seen, kept = [], dedup._to_first
    monkeypatch.setattr(dedup, "_to_first", lambda k: seen.append(k.count()) or kept(k))
    got = {r.seq: r.component for r in dedup.near_components(spark.createDataFrame(rows, "seq long, text string"), S.clean.minhash).collect()}
    assert got == h.classes([(i, bands_of(t)) for i, t in rows])
    assert seen == [40, 3 * S.clean.minhash.bands]  # three texts


def test_exact_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "seq long, text string")
    assert {r.seq: r.first_seq for r in dedup.exact_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}
    scopes = spark.createDataFrame([("https://h.example/x",), ("nothing",)], "u string").select(dedup.scope_of(F.col("u"), "per_source")).collect()
    assert [r[0] for r in scopes] == ["per_source:h.example", "per_source:nothing"]


def test_benchmark_overlap(spark, monkeypatch):
    sentence = "What is the name of the river that runs through the old capital of France today"
    docs = spark.createDataFrame([(1, f"Before. {sentence.upper()}! After."), (2, sentence[:40]), (3, ""), (4, None)], "seq long, text string")
    bench = spark.createDataFrame([(sentence,), (sentence,), (None,)], "text string")
    assert {r.seq: r.n_hits for r in decontam.hits(docs, bench, 13).collect()} == {1: 4}
    monkeypatch.setattr(decontam, "BROADCAST", 1)
    assert {r.seq: r.n_hits for r in decontam.hits(docs, bench, 13).collect()} == {1: 4}


def test_profile(spark):
    rows = [(1, h.EN, "en", "https://a.example/1", "cc-by", ["email"]), (2, "short", "en", "https://a.example/2", None, ["email", "ip"]), (3, "", None, None, "unknown", [])]
    f = profile.facts(spark.createDataFrame(rows, "seq long, text string, lang string, source_url string, license string, pii_found array<string>"))
    got = {(r.metric, r.key): r.n for r in profile.distributions(f).collect()}
    assert got == {("lang", "en"): 2, ("lang", "und"): 1, ("license", "cc-by"): 1, ("license", "unknown"): 2, ("host", "a.example"): 2, ("host", "?"): 1, ("length", "[50,200)"): 1, ("length", "[0,50)"): 2}
    assert [r.host for r in profile.top_hosts(f, 1).collect()] == ["a.example"]
    assert {r.type: r.n for r in profile.pii_counts(f).collect()} == {"email": 2, "ip": 1}
    assert {(r.kind, r.key) for r in profile.suggestions(f).collect()} == {("license", "unknown"), ("near_empty", "")}
    assert profile.length_stats(f.limit(0)).count() == 0 and profile.length_stats(f).first().near_empty == 2


def test_mix_takes_prefixes_up_to_the_budget(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["vi", "en", "en", "fr"]), rng.randint(0, 30)) for i in range(0, 900, 3)]
    ratios = {"vi": 0.5, "en": 0.4, "xx": 0.1}
    df = spark.createDataFrame(rows, "seq long, lang string, tokens long").repartition(3)
    tokens = {k: sum(t for _, g, t in rows if g == k) for k in ("vi", "en")}
    total, want = min(tokens[k] / ratios[k] for k in tokens), []
    for k in tokens:
        used = 0
        for s, g, t in rows:
            if g == k and used < ratios[k] * total:
                want.append(s)
                used += t
    assert sorted(r.seq for r in mix.select(df, ratios).collect()) == sorted(want)
    assert mix.select(df, {"xx": 1.0}).count() == len(rows)
    real = [r.ratio_real for r in mix.manifest(mix.select(df, ratios), ratios).collect()]
    assert abs(sum(real) - 1) < 0.002


def test_record_text(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", None)], None, None, "t"), (None, "i", "o", "t"), (None, None, "o", "t"), (None, None, None, "t"), (None, None, None, None)], f"messages {sft.MESSAGES}, instruction string, output string, text string")
    assert [r[0] for r in df.select(mix.record_text(df.columns)).collect()] == ["a ", "i o", " o", "t", ""]


def test_fine_tuning_formats_and_gates(spark):
    turns = [("system", "s"), ("user", "u"), ("assistant", "a")]
    prov = ("cc-by", "https://x.example")
    rows = [("1", "t", turns, prov), ("2", "t", None, prov), ("3", "t", [("robot", "x")], prov), ("4", "t", None, ("unknown", "u")), ("5", "t", None, None), ("6", "t", None, ("mine", "u"))]
    df = spark.createDataFrame([(*r[:2], "en", *r[2:]) for r in rows], f"id string, text string, lang string, messages {sft.MESSAGES}, prov struct<license:string,source_url:string>")
    gated = sft.gate(df)
    assert {r.id: r.drop_reason for r in gated.collect()} == {"1": None, "2": None, "3": "invalid_record", "4": "license_unknown", "5": "no_provenance", "6": "invalid_record"}
    import json

    kept = gated.filter("drop_reason IS NULL")
    out = {f: {r.id: json.loads(r.record) for r in sft.serialize(kept, f).collect()} for f in sft.FORMATS}
    assert out["chatml"]["1"]["messages"] == [{"role": r, "content": c} for r, c in turns]
    assert [x["from"] for x in out["sharegpt"]["1"]["conversations"]] == ["system", "human", "gpt"]
    assert {k: out["alpaca"]["1"][k] for k in ("instruction", "input", "output")} == {"instruction": "u", "input": "", "output": "a"}
    assert out["alpaca"]["2"]["output"] == "t" and out["chatml"]["2"]["meta"]["is_publishable"] is True


def test_synthetic_pairs(spark):
    def llm(messages):
        if "broken" in messages[1]["content"]:
            return "no json"
        if len(messages) == 2 and "retry" in messages[1]["content"]:
            return '{"pairs": []}'
        return 'Sure: {"pairs": [{"question": "q", "answer": "a"}, {"question": "r", "answer": "b"}, {"question": "s", "answer": "c"}]} done'

    df = spark.createDataFrame([("1", "fine"), ("2", "broken"), ("3", "retry")], "id string, text string")
    got = sorted((r.id, r.n, r.drop_reason) for r in sft.synthesize(df, llm, "m").collect())
    assert got == [("1", 0, None), ("1", 1, None), ("2", None, "synth_failed"), ("3", 0, None), ("3", 1, None)]


def test_robots_sitemap_and_crawl(spark):
    text = "User-agent: *\nCrawl-delay: 2\nDisallow: /no\n# Disallow: /x\nDisallow:\nSitemap: https://a.example/s.xml\ncrawl-delay: soon\nnonsense"
    r = spark.createDataFrame([(text,), (None,)], "t string").select(crawl.parse_robots(F.col("t"))).collect()
    assert tuple(r[0][0]) == (2.0, ["https://a.example/s.xml"], ["/no"]) and tuple(r[1][0]) == (None, [], [])
    link = lambda *u: "".join(f'<a href="{x}">.</a>' for x in u)
    base = "https://a.example"
    pages = {f"{base}/": link("/1", "/no/1", "/x", "https://b.example/"), f"{base}/1": link("/2", "/"), f"{base}/2": link("/3"), f"{base}/3": "", f"{base}/no/1": "", f"{base}/x": link("/hidden"), f"{base}/hidden": ""}
    df = spark.createDataFrame(list(pages.items()), "url string, html string")
    seeds, rules = df.filter(F.col("url") == f"{base}/").select("url"), spark.createDataFrame([("a.example", ["/no"])], "host string, disallow array<string>")
    got = {r.url.removeprefix(base): (r.depth, r.outcome) for r in crawl.crawl(df, seeds, replace(S.crawl, max_depth=2, url_exclude=["/x$"]), rules).collect()}
    assert got == {"/": (0, "fetched"), "/1": (1, "fetched"), "/no/1": (1, "robots_disallowed"), "/x": (1, "url_excluded"), "/2": (2, "fetched")}
    capped = [r.outcome for r in crawl.crawl(df, seeds, replace(S.crawl, max_depth=6, per_host_concurrency=0)).collect()]
    assert set(capped) == {"host_cap"}
    few = [r.outcome for r in crawl.crawl(df, seeds, replace(S.crawl, max_depth=6, max_pages=1)).collect()]
    assert few.count("fetched") == 1 and few.count("page_cap") > 0 and len(few) == len(crawl.crawl(df, seeds, replace(S.crawl, max_depth=6)).collect())
    for bad in (replace(S.crawl, respect_robots=False), replace(S.crawl, render="browser")):
        with pytest.raises(ValueError):
            crawl.crawl(df, seeds, bad)
    delays = spark.createDataFrame([(None,), (5.0,), (99.0,)], "d double").select(crawl.delay_of(F.col("d"), S.crawl)).collect()
    assert [r[0] for r in delays] == [1.0, 5.0, 30.0]


def test_settings(tmp_path):
    for bad in (lambda: MinHash(scope="global"), lambda: Integrate(mix_ratios={"vi": 0.9}), lambda: from_dict(Settings, {"clean": {"lang_score_min": {"en": 2}}}), lambda: DatasetPlan("g", []), lambda: DatasetPlan("g", ["ftp://x"]), lambda: DatasetPlan("g", ["http://x"], max_depth=7)):
        with pytest.raises(ValueError):
            bad()
    path = tmp_path / "c.yaml"
    path.write_text("global:\n  seed: 7\ncrawl:\n  max_depth: 1\nclean:\n  lang_allow: [vi]\n  minhash:\n    bands: 7\n")
    s = load(str(path))
    assert (s.seed, s.crawl.max_depth, s.clean.lang_allow, s.clean.minhash.bands, s.clean.minhash.rows) == (7, 1, ["vi"], 7, 8)
    plan = DatasetPlan("g", ["https://x"], max_depth=4, lang_allow=["en"], build_format="alpaca", quality_min_score=0.9, url_exclude=["/a", "/a"])
    got = apply_plan(s, plan)
    assert (got.crawl.max_depth, got.clean.lang_allow, got.build.format, got.clean.quality.min_score, got.crawl.url_exclude) == (4, ["en"], "alpaca", 0.5, ["/a"])
