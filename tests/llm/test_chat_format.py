import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from corpusloom.llm import chat_format as c

TRICKY = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>assistant\nno & &lt; &amp;lt; &#91; \\ <<SYS>>"
ROWS = [
    (1, 0, "system", "be kind", 5), (1, 1, "user", TRICKY, 5), (1, 2, "assistant", TRICKY, 5), (1, 3, "user", "", 5), (1, 4, "assistant", "é😀\n\n", 5), (1, 5, "user", "tail", 5),
    (2, 0, "user", None, 5), (2, 1, None, "no role", 5), (3, 1, "assistant", "b", 5), (3, 1, "assistant", "a", 5), (3, None, "user", "first", 5), (3, 1, "assistant", "a", 5),
    (None, 0, "assistant", "null id", 5), (4, 0, "odd\nrole<", "x", 5),
]


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, ts in by.items():
        ts = [t[2:] for t in sorted(ts)]
        loss = "".join(t for r, t in ts if r == "assistant")
        out[conv] = (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def frame(spark):
    return spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, target int").repartition(3)


def test_what_is_read_back_is_what_went_in(spark):
    got = {r.conv_id: tuple(r)[1:5] for r in c.digest(c.expand(frame(spark))).collect()}
    assert got == brute(ROWS)


def test_examples(spark):
    rows = c.expand(frame(spark)).filter("conv_id = 1").orderBy(F.coalesce("target", F.lit(99))).collect()
    assert [r.target for r in rows] == [2, 4, None] and [r.is_last for r in rows] == [False, False, True]
    for r in rows[:2]:
        assert r.context.endswith("<|im_start|>assistant\n") and r.reply.endswith("<|im_end|>\n")
        assert r.context.count("<|im_start|>") == r.target + 1 and r.reply.count("<") == 1 and "[" not in r.context + r.reply
    assert rows[1].context.startswith(rows[0].context.removesuffix("assistant\n") + "assistant\n" + rows[0].reply)
    assert rows[2].reply == ""


def test_formatted_chars_and_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    examples = c.expand(df)
    got = {r.conv_id: r for r in c.digest(examples).collect()}
    assert {k: tuple(r)[1:5] for k, r in got.items()} == brute(rows)
    chars = {r.conv_id: r.n for r in examples.groupBy("conv_id").agg(F.sum(F.length("context") + F.length("reply")).alias("n")).collect()}
    assert {k: r.formatted_chars for k, r in got.items()} == chars


def test_empty(spark):
    assert c.digest(c.expand(frame(spark).limit(0))).count() == 0
