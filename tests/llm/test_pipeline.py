import random
from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from test_quality_rules import corpus
from test_similar import brute as near_classes


@pytest.fixture
def made(spark, tmp_path):
    """A folder with enough labels for certified cutoffs, and edited copies."""
    rng = random.Random(11)
    rows, labels = corpus()
    rows = [(i, lang, text, f"s{(i or 0) % 4}") for i, lang, text in rows]
    for i, lang, text, source in rows[100:160]:
        words = (text or "").split()
        for at in rng.sample(range(len(words)), min(len(words), rng.randint(0, 3))):
            words[at] = f"edit{rng.randrange(10**6)}"
        rows.append((i + 20_000, lang, " ".join(words), source))
    spark.createDataFrame(rows, "doc_id long, lang string, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("which", ["sf0.001", "made"])
def test_against_brute_force(spark, which, request):
    folder = request.getfixturevalue("made") if which == "made" else f"/root/testdata/{which}"
    docs = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.doc_id is not None and (which != "made" or r.doc_id != 0)]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    if which == "made":  # without the rows with a null id or an id twice, which have tests of their own
        spark.createDataFrame(docs, "doc_id long, lang string, text string, source string").write.parquet(f"{folder}/own/documents.parquet")
        spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{folder}/own/labels.parquet")
        folder += "/own"
    judged = brute.quality([(r.doc_id, r.lang, r.text) for r in docs], labels)
    kept = {d for d, _, k in judged if k}
    assert which != "made" or sum(not c["base_failed"] and not k for _, c, k in judged) > 50  # certified cutoffs reject
    rows = [r for r in docs if r.doc_id in kept]
    first = {i for i, c in near_classes([(r.doc_id, r.text) for r in rows]) if i == c}
    assert which != "made" or len(first) < len(rows) - 20
    rows = [r for r in rows if r.doc_id in first]
    times = {r[0]: r[5] for r in brute.mix([(r.doc_id, r.text, r.source) for r in rows])}
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter({d: n for d, n in times.items() if n})
    text, lib = {r.doc_id: r.text for r in docs}, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(r.lossless and lib.decode(r.ids) == text[r.doc_id] for r in got)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    folder = "/root/testdata/sf0.001"
    good = "The quick brown fox of the hill and the river that runs with all its might " * 1
    words = " ".join(f"{w}{i}" for i in range(9) for w in good.split())
    rows = [(1, words, "en", "a", 1, "x"), (1, words, "en", "a", 1, "x"), (2, None, None, None, None, None), (None, words + " null id", "en", None, 2, ""), (3, words + " " + words[::-1], None, "b", 3, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in out.collect()}
        assert {1, None} <= ids or name == "mixing to target weights"
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)
