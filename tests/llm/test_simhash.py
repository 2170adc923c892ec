import random
import re

import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import simhash
from corpusloom.operators.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, fp string, id long"


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = {}
    for i, t in rows:
        fps.setdefault(fingerprint(t), []).append(i)
    return classes(fps)


def classes(fps):
    todo, out = set(fps), []
    while todo:
        group = [todo.pop()]
        for a in group:
            near = {b for b in todo if (a ^ b).bit_count() <= 2}
            todo -= near
            group += near
        least = min(i for f in group for i in fps[f])
        out += [(i, f"{f:016x}", least) for f in group for i in fps[f]]
    return sorted(out)


def rows_of(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(1, 60)]
    for i in range(60, 140):
        words = rows[i % 8][1].split()
        words += rng.choices(vocabulary, k=300)[: 300 if i < 8 else 0]
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, "  ".join(words).upper() if i % 3 else "\n".join(words)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (5, rows[4][1]), (5, rows[4][1]), (205, "long " * 3000 + "x")]
    df = spark.createDataFrame([(*r, "s", "clash", 7) for r in rows], DOCS)
    assert rows_of(simhash.near_duplicates(df)) == brute(rows)


def test_documents_of_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows_of(simhash.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_links_of_crowded_keys(spark):
    """More fingerprints under one key than are joined pairwise, in chains and apart."""
    rng, fps = random.Random(2), set()
    for base in (0, 0xFFFF0000FFFF0000, rng.getrandbits(64)):
        f = base
        for _ in range(120):
            f ^= 1 << rng.randrange(0, 32)
            fps.add(f)
            fps.add(f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    ids = {f: [i] for i, f in enumerate(sorted(fps, key=lambda x: hash((x, 1))))}
    nodes = spark.createDataFrame([(i[0], signed(f)) for f, i in ids.items()], "id long, fp long")
    labels = {r.node: r.label for r in components(simhash.links(nodes)).collect()}
    assert sorted((i[0], labels.get(i[0], i[0])) for i in ids.values()) == sorted((i, c) for i, _, c in classes(ids))


def test_empty_table_and_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(None, "a b c", "s", "", 1), (3, "a b c", "s", "", 2), (4, "A  b c", None, "", 3)], DOCS)
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {(None, None), (3, 3), (4, 3)}
    kept = simhash.one_of_each(df.union(df))
    assert kept.columns == df.columns and sorted(kept.select(F.coalesce("doc_id", F.lit(-1))).toPandas().iloc[:, 0]) == [-1, -1, 3]


def test_long_slices_are_counted_in_blocks():
    import numpy as np

    rng = np.random.default_rng(0)
    values = rng.integers(-(2**63), 2**63, simhash._BLOCK * 2 + 77)
    offsets = np.array([0, 0, 3, simhash._BLOCK * 2 + 50, simhash._BLOCK * 2 + 77, simhash._BLOCK * 2 + 77])
    want = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        bits = np.unpackbits(values[a:b].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
        want.append(sum(1 << i for i in range(64) if 2 * int(bits[i]) > b - a))
    assert [int(x) & (1 << 64) - 1 for x in simhash.majority_bits(values, offsets)] == want
