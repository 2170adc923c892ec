import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_simhash import DOCS, WORD

from corpusloom.llm import simhash, similar


def shingles(text, size=5):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([" ".join(w)] if w else [])


def brute(rows, least=0.8):
    sets = [(i, shingles(t)) for i, t in rows]
    at = {i: i for i, _ in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a == b or a & b and len(a & b) / len(a | b) >= least:
                x, y = root(i), root(j)
                at[max(x, y)] = min(x, y)
    return sorted((i, root(i)) for i, _ in sets)


def rows_of(df):
    return sorted((r.doc_id, r.component_id) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("often", [1, 10**9])
def test_against_all_pairs(spark, monkeypatch, often):
    """Around the threshold, in crowds and chains, and with a passage that many have."""
    monkeypatch.setattr(similar, "OFTEN", often)
    monkeypatch.setattr(similar, "SAMPLE", 2)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    base, passage = [[word() for _ in range(n)] for n in (14, 60, 200, 200)], [word() for _ in range(30)]
    texts = [edited(rng, b, rng.randint(0, max(1, len(b) // 40))) for b in base for _ in range(30)]
    texts += [" ".join(passage + [word() for _ in range(rng.randint(0, 60))]) for _ in range(40)]
    chain = list(base[1])
    for i in range(12):
        chain[5 * i] = f"c{i}"
        texts.append(" ".join(chain))
    texts += ["", None, " \n", "one", "ONE", "a b c d", "a b c d e", "a b c d e f g h i", "a b c d e f g h i j"]
    rows = list(enumerate(texts, 1)) + [(3, texts[2])]
    df = spark.createDataFrame([(*r, "s", "clash", 7) for r in rows], DOCS).repartition(3)
    got = rows_of(similar.near_duplicates(df))
    assert got == brute(rows)
    assert len({c for _, c in got}) < len(rows) - 60


def test_stage_finds_edited_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    near, far = edited(rng, base, 4), edited(rng, base, 40)
    docs = spark.createDataFrame([(1, " ".join(base)), (2, near), (3, far), (None, near)], "doc_id long, text string")
    assert len(shingles(near) & shingles(docs.first().text)) / len(shingles(near) | shingles(docs.first().text)) >= 0.8
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 1, 3]
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_texts_under_one_id_and_repeated_rows(spark):
    """Unlike texts under one id both stay, of like ones and of equal rows one."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(100)]
    other, near = [f"v{rng.randrange(3000)}" for _ in range(100)], edited(rng, base, 1)
    rows = [(1, " ".join(base)), (1, " ".join(other)), (1, near), (2, near), (2, near), (3, " ".join(other)), (4, None), (5, ""), (None, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for module in (similar, simhash):
        kept = [(r.doc_id, r.text) for r in module.one_of_each(docs).collect()]
        of_one = [t for i, t in kept if i == 1]
        assert " ".join(other) in of_one and (4, None) in kept and (None, near) in kept
        assert len(kept) == (4 if module is similar else len(set(kept))) and not {3, 5} & {i for i, _ in kept}
    got = [(r.doc_id, r.text) for r in similar.one_of_each(docs).collect()]
    assert len([t for i, t in got if i == 1]) == 2 and 2 not in {i for i, _ in got}


def test_ring_keys_meet_within_the_distance(spark):
    """Every two fingerprints within the distance have a key in common; for op4's distance the keys are op4's."""
    rng = random.Random(5)
    assert simhash.ring_masks(2, 2) == sorted(0xFFFF << 16 * i | 0xFFFF << 16 * j for (i, j), _ in simhash.KEYS)
    for distance, equal in ((2, 2), (3, 2), (similar.DISTANCE, similar.EQUAL), (6, 3)):
        masks = simhash.ring_masks(distance, equal)
        for _ in range(2000):
            x = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(not x & m for m in masks)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = [rng.getrandbits(64) for _ in range(50)]
    rows = [(signed(f), signed(f ^ sum(1 << b for b in rng.sample(range(64), similar.DISTANCE)))) for f in fps]
    keys = [simhash.ring_keys(F.col(c), similar.DISTANCE, similar.EQUAL) for c in "ab"]
    got = spark.createDataFrame(rows, "a long, b long").select(F.size(keys[0]).alias("n"), F.size(F.array_intersect(*keys)).alias("both")).collect()
    assert all(r.n == 56 and r.both >= 1 for r in got)


def fingerprint(text):
    """Of the set of shingles, each counted once, by the hashes of the module."""
    values, n = similar.shingle_sets(pa.array([text]), 5, np.empty(0, np.int64))
    return sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in values) > n[0])


def test_stage_goes_by_fingerprints(spark, monkeypatch):
    """Fingerprints alone link just the similar pairs within the distance; with the shingles behind them none is missed."""
    rng = random.Random(12)
    rows = []
    for k in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(200)]
        rows += [(10 * k + 1, " ".join(base))] + [(10 * k + 2 + i, edited(rng, base, n)) for i, n in enumerate((1, 1, 2, 4, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, fps = {i: shingles(t) for i, t in rows}, {i: fingerprint(t) for i, t in rows}
    near = {i: i for i, _ in rows}
    for i, _ in rows:  # ids grow, so that the class of the earlier one is the smaller one
        for j, _ in rows:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= similar.DISTANCE and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                x, y = near[i], near[j]
                near = {k: min(x, y) if c in (x, y) else c for k, c in near.items()}
    kept = lambda: sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    whole = [i for i, c in brute(rows) if i == c]
    assert kept() == whole
    monkeypatch.setattr(similar, "links", lambda texts, rows, size, similarity, found: found)
    alone = [i for i, c in near.items() if i == c]
    assert kept() == alone
    assert len(whole) < len(alone) < len(rows) - 12  # both steps have work
