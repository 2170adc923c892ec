import random

import public_tokenizers
from tokenizers import Tokenizer

from corpusloom.llm import token_counts as tc
from corpusloom.llm.common import byte_groups

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "a\n b", "a \n\n  b<|endoftext|> c", "<|endoftext|>", "<|endoftext|>   x", "\n\n a b  \t c ", "a\x1c b\x1f  c", "don't  stop 123abc", "é  ü  x", "日本 語 ", "x" * 5000, " " * 999, "it 's", "　wide  space"]


def texts():
    rng = random.Random(9)
    return ODD + ["".join(rng.choices("ab'sé1 .\n\t<|endoftext|>　", k=rng.randint(1, 300))) for _ in range(300)]


def whole(xs):
    lib = Tokenizer.from_file(PATH)
    return [len(lib.encode(x, add_special_tokens=False).ids) for x in xs]


def test_counts_are_those_of_the_whole_texts():
    xs = texts()
    assert tc.PieceCounter(PATH).counts(xs) == whole(xs)
    assert all("".join(tc.safe_pieces(x)) == x for x in xs)


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "CACHE_ENTRIES", 10)
    counter, xs = tc.PieceCounter(PATH), texts()
    assert [counter.counts([x])[0] for x in xs] == whole(xs)


def test_groups_cover_the_rows_in_order():
    sizes = [5, 0, 7, 100, 1, 1, 30]
    groups = list(byte_groups(sizes, 10))
    assert [i for g in groups for i in g] == list(range(7)) and all(sum(sizes[i] for i in g) <= 10 or len(g) == 1 for g in groups)
    assert list(byte_groups([], 10)) == []


def test_documents(spark):
    rows = [(1, "one two", 7), (1, "one two", 7), (2, None, 8), (None, "x", 9), (3, "word " * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tc.count_tokens(df, PATH).collect()))
    n = dict(zip([r[1] for r in rows], whole([r[1] or "" for r in rows]), strict=True))
    assert got == sorted((i or 0, len((t or "").encode()), n[t], n[t] > 1024) for i, t, _ in rows)
    assert tc.count_tokens(df.limit(0), PATH).count() == 0


def test_documents_of_the_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = d.select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], whole([r.text for r in rows]), strict=True))
    assert {r.doc_id: r.n_tokens for r in tc.count_tokens(d, PATH).collect()} == want
