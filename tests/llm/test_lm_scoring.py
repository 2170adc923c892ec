import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import gru, lm_scoring


def prose(n=300, seed=3):
    """Each word is followed by one of few: what goes before tells much."""
    rng = random.Random(seed)
    after = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        words, w = [], f"w{rng.randrange(60)}"
        for _ in range(rng.randint(1, 120)):
            words.append(w.upper() if rng.random() < 0.1 else w)
            w = rng.choice(after[w])
        rows.append((i, "\n ".join(words) + (f" rare{i}" if i % 3 else "")))
    return rows


def brute(rows):
    texts = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, ws in texts if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in texts]


@pytest.mark.parametrize("hot", [20, 1000])
def test_counts_base_and_held_out_accuracy(spark, hot):
    rows = [*prose(), (900, None), (901, ""), (901, ""), (None, "w1 w2"), (902, "É é   x"), (903, "only words never seen " * 30)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, score long").repartition(3)
    got = lm_scoring.score(df, vocabulary_size=40, hot=hot).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert [r[:5] for r in sorted((tuple(r) for r in got), key=order)] == [r[:5] for r in sorted(brute(rows), key=order)]
    want = {r[0]: r[5] for r in brute(rows)}
    assert all(abs(r.base_score - want[r.doc_id]) < 1e-6 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.03 * sum(r.n_tokens for r in held)


def test_every_training_document_is_learned_from(spark):
    """By default, and each once: the copies' weights add up to all training tokens."""
    df = spark.createDataFrame(prose(), "doc_id long, text string").repartition(3)
    seen, average = [], lm_scoring._average

    def counted(copies):
        rows = lm_scoring.cut(copies)
        seen.append(rows.filter("chunk = 0").groupBy().sum("weight").first()[0] or 0)
        return average(rows)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(lm_scoring, "_average", counted)
        got = lm_scoring.score(df, vocabulary_size=40).first()
    assert sum(seen) == got.train_tokens and len(seen) == lm_scoring.ROUNDS


def test_empty_table_and_no_training_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.score(empty).count() == 0
    held = next(i for i in range(100) if lm_scoring.crc_held(i))
    r = lm_scoring.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score) and math.isfinite(r.base_score)


def plain_score(model, text):
    """Word by word, in double precision, with the weights that were learned."""
    p = {k: v.astype(float) for k, v in gru.unpack(model.flat, model.like).items()}
    v, size, n = model.vocabulary, p["w"].shape[2], p["u"].shape[0]
    counts = {r.word.encode(): r.c for r in model.counts.collect()}
    number = dict(zip([w.encode() for w in v.words.to_pylist()], v.numbers.tolist(), strict=False))
    rare = [c for w, c in counts.items() if w not in number and w != b"\n"]
    mass, u = sum(rare), sum(c > 0 for c in rare)
    soft = lambda x: x - x.max() - math.log(np.exp(x - x.max()).sum())
    h, before, out = np.zeros(n), v.end, 0.0
    for w in (text or "").encode().lower().split() + [b"\n"]:
        k = v.end if w == b"\n" else number.get(w, v.other)
        a = p["x"][before] + p["xb"] + h @ p["u"]
        z, new = 0.5 + 0.5 * np.tanh(a[:n]), np.tanh(a[n:])
        h = z * h + (1 - z) * new
        one = np.append(h, 1)
        out += soft(one @ p["c"])[k // size] + soft(one @ p["w"][k // size])[k % size]
        if k == v.other:
            out += math.log((counts.get(w, 0) + 0.1) / (mass + 0.1 * (u + 1)))
        before = k
    return out / math.log(10)


@pytest.mark.parametrize("hot", [20, 1000])
def test_scores_are_those_of_the_learned_weights(spark, hot):
    rows = [*prose(60), (900, None), (901, ""), (902, "never seen words É"), (903, "w1 w2 rare3 " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = lm_scoring.learn(df, vocabulary_size=30, hot=hot)
    got = {r.doc_id: r.score for r in lm_scoring.score(df, learned=model).collect()}
    for i, text in rows:
        want = plain_score(model, text)
        assert abs(got[i] - want) < 1e-4 * max(1, abs(want)), i


def test_every_document_has_influence():
    """Training without any one of the documents, or with one word of it changed, gives other weights."""
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(0, 60, n), 63).astype(np.int32) for n in (1, 40, 5, 900, 64, 63, 200, 0, 7)]
    p = gru.init(np.arange(64.0, 0, -1), hidden=4)
    all_of_them = gru.pack(gru.train(p, docs, 63))
    for i, d in enumerate(docs):
        assert not np.array_equal(all_of_them, gru.pack(gru.train(p, docs[:i] + docs[i + 1 :], 63))), i
        if len(d) > 1:
            other = d.copy()
            other[len(d) // 2] = (other[len(d) // 2] + 1) % 60
            assert not np.array_equal(all_of_them, gru.pack(gru.train(p, [*docs[:i], other, *docs[i + 1 :]], 63))), i


def test_the_vocabulary_grows_with_the_corpus():
    sizes = [lm_scoring.grown(n) for n in (0, 10**5, 4 * 10**6, 10**8, 10**12)]
    assert sizes == [254, 510, 2046, 4094, 4094]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in gru.init(np.arange(70.0, 0, -1), hidden=3).items()}
    p["w"] = np.maximum(p["w"], -5)
    word = rng.integers(0, 70, (6, 4))
    before, live, h = np.vstack([word[:1] * 0, word[:-1]]), rng.random((6, 4)) < 0.8, rng.normal(0, 1, (4, 3))
    some, where, _, _ = gru.gradients(p, before, word, live, h, 5)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    for k, x in some.items():
        g[k][where.get(k, slice(None))] = x
    for k in p:
        for at in [tuple(rng.integers(0, n) for n in p[k].shape) for _ in range(6)] + ([(int(before[1, 0]), 2)] if k == "x" else []):
            old, e = p[k][at], 1e-4
            p[k][at] = old + e
            up = gru.gradients(p, before, word, live, h, 5)[3]
            p[k][at] = old - e
            down = gru.gradients(p, before, word, live, h, 5)[3]
            p[k][at] = old
            assert abs((up - down) / (2 * e) - g[k][at]) < 1e-5, (k, at)


def test_state_is_carried_over_windows_and_probabilities_add_up():
    rng = np.random.default_rng(1)
    p = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in gru.init(np.arange(64.0, 0, -1)).items()}
    docs = [np.append(rng.integers(0, 60, n), 63) for n in (0, 1, 5, 300, 64, 63, 200)]
    got = gru.log_likelihoods(p, docs, 63)
    for d, ll in zip(docs, got, strict=True):
        h, before, want = np.zeros((1, gru.HIDDEN), np.float32), 63, 0.0
        for w in d:
            h = gru._step(p["u"], p["x"][[before]] + p["xb"], h)[-1]
            want += gru.word_log_probs(p, h, np.array([w]))[0]
            before = w
        assert abs(ll - want) < 1e-3 * max(1, abs(want))
    h = rng.normal(0, 1, (1, gru.HIDDEN)).astype(np.float32)
    assert abs(np.exp(gru.word_log_probs(p, np.repeat(h, 64, axis=0), np.arange(64))).sum() - 1) < 1e-4


def test_shares_of_rows_far_below_the_others():
    x = np.array([[1.0, 2, -1e4], [-300, -301, -302], [90, 0, 1], [-1e4, -1e4, 5]], np.float32)
    assert np.allclose(np.exp(gru._soft(x.copy(), np.array([1, 2, 0, 2]), 1.0)[1]), [0.731059, 0.090031, 1, 1], atol=1e-4)
    at = np.array([1, 2, 2, 2])
    want = gru._log_softmax(x)[np.arange(4), at]
    assert np.allclose(gru._log_share(x.copy(), at), want, atol=1e-4)
