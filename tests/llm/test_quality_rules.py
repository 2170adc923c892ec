import math
import random

import brute
from pyspark.sql import functions as F

from corpusloom.llm import quality_rules as q


def test_exact_binomial_tail(spark):
    cases = [(0, 10), (0, 500), (1, 900), (3, 2000), (17, 5000), (60, 20_000), (5, 6), (10, 1000)]
    df = spark.createDataFrame(cases, "k long, n long").coalesce(1)
    for p in (0.004, 0.02):
        got = [r[0] for r in df.select(q.binomial_tail(F.col("k"), F.col("n"), p)).collect()]
        for (k, n), x in zip(cases, got, strict=True):
            want = float(brute.tail(k, n, p)) if k < n * p else 1.0
            assert math.isclose(x, want, rel_tol=1e-9), (k, n, p)


def corpus():
    """Clean documents of two languages, junk with many symbols, and labels for most."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(3000):
        lang = ("en", "de", None)[i % 3 if i % 10 else 2]
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(40, 90))]
        bad = rng.random() < 0.2
        if bad:
            words = [w + "#*$"[rng.randrange(3)] * rng.randint(1, 4) for w in words]
        elif rng.random() < 0.01:
            words = [w + "#" for w in words]
        rows.append((i, lang, " ".join(words)))
        if rng.random() < 0.9:
            labels.append((i, int(not bad), 7))
    rows += [(9001, "en", None), (9002, "en", ""), (9003, None, " \n\t"), (0, *rows[0][1:]), (None, "en", rows[1][2]), (9004, "en", "a b c " * 40), (9005, "en", "x\nx\n\nx y\n \nx y z"), (9006, "en", "é" * 30 + " |" * 60)]
    labels += [(1, 0, 7), (5, None, 7), (None, 1, 7)]
    return rows, labels


def test_against_brute_force(spark):
    rows, labels = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, lang string, text string, n_words int").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    counts = q.cut(q.text_counts(df))
    cutoffs = q.cut(q.certified_cutoffs(counts, lab, alpha=0.05))
    key = lambda r: (r[0] is None, r[0] or 0)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = sorted([(r["_row"]["doc_id"], *[r[c] for c in names]) for r in q.judge(counts, cutoffs).collect()], key=key)
    want = sorted([(d, *[c[n] for n in names[:-1]], kept) for d, c, kept in brute.quality(rows, [x[:2] for x in labels], 0.05)], key=key)
    assert got == want
    assert cutoffs.count() >= 2 and any(not r[-1] and not r[-2] for r in got)
    # at the production level
    kept = q.kept_rows(df, lab)
    assert kept.columns == df.columns and kept.count() == sum(k for _, _, k in brute.quality(rows, [x[:2] for x in labels]))
    # without labels only the base rules act
    alone = q.judge(counts, q.cut(q.certified_cutoffs(counts, lab.limit(0))))
    assert alone.filter("kept = base_failed").count() == 0
    assert q.kept_rows(df.limit(0), lab).count() == 0


def test_false_rejections_stay_within_alpha(spark):
    rows, labels = corpus()
    good = {d for d, ok, _ in labels if ok and d is not None}
    verdict = {d: kept for d, c, kept in brute.quality(rows, [x[:2] for x in labels], 0.05) if not c["base_failed"]}
    for lang in ("en", "de"):
        own = [verdict[d] for d, g, _ in rows if g == lang and d in good and d in verdict]
        assert 0 < len(own) and 1 - sum(own) / len(own) <= 0.05


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "en", "w" * 100 + " x" * 200_000)], "doc_id long, lang string, text string")
    r = q.text_counts(df).first()
    assert (r.n_words, r.n_repeat_words) == (200_001, 200_000)


def test_certified_cutoffs_act_at_the_production_level(spark):
    """On the table of 10000 documents they reject bad documents that the base rules keep, and good ones within alpha."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    counts = q.cut(q.text_counts(docs))
    out = q.judge(counts, q.cut(q.certified_cutoffs(counts, labels))).filter("not base_failed").select("_row.doc_id", "kept")
    by = {r.quality: r for r in out.join(labels, "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("k")).collect()}
    assert by[0].k > 0.3 * by[0].n and by[1].k <= q.ALPHA * by[1].n, by
