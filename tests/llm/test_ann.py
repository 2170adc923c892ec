import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=10):
    rows = {i: v for i, v, *_ in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(rows))
    x = np.array([np.array(rows[i], np.float32).astype(float) for i in ids])
    out = {}
    for q in ids[ids % 5 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    out = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 5 == 0, **kw).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def vectors(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 8)) + 4 * rng.normal(0, 1, (12, 8))[rng.integers(0, 12, n)]
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def test_all_leaves_give_the_exact_result(spark):
    rows = vectors()
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(60)] + [(2000, None), (2005, [0.0] * 8), (2010, [float("nan")] + [1.0] * 7), (2015, [float("inf")] + [1.0] * 7), (2020, [None] + [1.0] * 7), (2025, [1.0] * 3), (None, [1.0] * 8), (3, same)]
    got, want = run(spark, rows, target=1.0), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12) and (q % 25 or [i for i, _ in got[q]] == [i for i, _ in want[q]])


def test_recall_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    data = df.collect()
    ids, x = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], float)
    hits = 0
    for q, found in got.items():
        d = ((x - x[ids == q][0]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits += len(found & {int(i) for i in ids[np.lexsort((ids, d))[:10]]})
    assert len(got) == (ids % 100 == 0).sum() and hits >= 0.9 * 10 * len(got)


def test_blocks_of_a_leaf_change_nothing(spark, monkeypatch):
    rows = vectors(200, 1)
    want = run(spark, rows, target=1.0)
    monkeypatch.setattr(ann, "ROWS", 7)
    monkeypatch.setattr(ann, "QUERIES", 2)
    assert run(spark, rows, target=1.0) == want


def test_few_rows_and_none(spark):
    assert run(spark, []) == {}
    assert run(spark, [(5, [1.0] * 8)]) == {}
    assert {q: [i for i, _ in v] for q, v in run(spark, [(5, [1.0] * 8), (6, [1.0] * 8), (7, [2.0] * 8)]).items()} == {5: [6, 7]}
