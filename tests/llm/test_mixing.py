import random

import brute
from pyspark.sql import functions as F

from corpusloom.llm import mixing


def rows(seed, sources, n=400):
    rng = random.Random(seed)
    out = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 300])), rng.choice(sources), "x") for i in range(n)]
    return [*out, (n, None, sources[0], None), (n + 1, "a\u00a0b c", None, ""), (None, "no id here", sources[-1], ""), (3, out[3][1], out[3][2], "again")]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, source string, size string").repartition(4)


def test_against_brute_force(spark):
    for seed, sources in ((1, ["a", "B", "é", "ß", "zz", "𝒳"]), (2, ["hot"] * 30 + ["b", "c", "d"]), (3, ["one"])):
        data = rows(seed, sources)
        want = sorted([x[:5] for x in brute.mix([(d, t, s) for d, t, s, _ in data])], key=str)
        got = sorted([tuple(r) for r in mixing.mix(frame(spark, data)).collect()], key=str)
        assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
        assert all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(got, want, strict=True))
        assert all(r[4] <= 3 * r[1] for r in got)
        taken = {}
        for d, size, ss, target, t in got:
            taken.setdefault((ss, target), []).append(t)
        assert all(abs(sum(v) - target) <= 1 for (_, target), v in taken.items())


def test_rows_of_the_mix(spark):
    data = rows(4, ["a", "b", "c", "hot", "hot", "hot"])[:-1]
    df = frame(spark, data)
    out = mixing.mix_rows(df)
    assert out.columns == df.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {x[0]: x[5] for x in brute.mix([(d, t, s) for d, t, s, _ in data]) if x[5]}


def test_water_filling_clamps_until_none_is_above(spark):
    sizes = {"a": 1, "b": 2, "c": 1000, "d": 5, "e": 0, None: 400}
    df = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
    got = {r["_source"]: r.target for r in mixing.water_fill(df).collect()}
    want = brute.mix_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in want)
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def test_empty_tables_and_texts(spark):
    df = frame(spark, rows(1, ["a"]))
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix_rows(df.limit(0)).count() == 0
    none = mixing.mix(df.withColumn("text", F.lit(None).cast("string"))).collect()
    assert all((r.size, r.taken, r.target) == (0, 0, 0.0) for r in none)
