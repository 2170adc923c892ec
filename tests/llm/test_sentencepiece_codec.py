import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from corpusloom.llm import sentencepiece_codec as sc

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a  b", "   a\n\n b ", "\n", "x\ty", "日本語 é ü", "\x00a", "<s> </s> <0x41>", "a▁b", "👍🏽 ok", "x" * 5000, "ab" * 3000 + " é" * 50, "é" * 47, "=" * 49, "hello wonderful world"]


def texts():
    rng = random.Random(5)
    return ODD + ["".join(rng.choices("abcdeéßth ing\n\t.0▂", k=rng.randint(1, 200))) for _ in range(200)]


def test_without_dropout_as_the_library():
    own, lib = sc.Codec(PATH, 0.0), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for x in texts():
        if "▁" not in x:
            assert list(own.encode(x)) == lib.encode(x), x


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.9])
def test_lossless(dropout):
    own, lib = sc.Codec(PATH, dropout), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for k, x in enumerate(texts()):
        ids = own.encode(x, k)
        assert own.decode(ids) == x
        assert lib.decode([int(i) for i in ids]) == x


def test_dropout_varies_by_seed_and_document_and_is_repeatable():
    x = " ".join(["encyclopaedia understanding"] * 20)
    a, b = sc.Codec(PATH, 0.2, 1), sc.Codec(PATH, 0.2, 2)
    assert list(a.encode(x, 1)) == list(sc.Codec(PATH, 0.2, 1).encode(x, 1))
    assert len({tuple(c.encode(x, k)) for c in (a, b) for k in (1, 2)}) == 4
    merged = skipped = 0
    for k, t in enumerate(texts()):
        symbols, n = a._short(t[:200], k * 7919)
        merged, skipped = merged + len(t[:200]) - len(symbols), skipped + n
    assert 0.17 < skipped / (merged + skipped) < 0.23


def test_long_texts_go_in_blocks_and_lookups_are_given_up(monkeypatch):
    some = [x for x in texts() if x] + ["", " ".join(["encyclopaedia understanding"] * 40)]
    keys = list(range(len(some)))
    whole = sc.Codec(PATH, 0.2).encode_batch(some, keys)
    monkeypatch.setattr(sc, "BLOCK", 3)
    own = sc.Codec(PATH, 0.2)
    for _ in range(2):
        got = own.encode_batch(some, keys)
        assert [x.tolist() for x in got] == [x.tolist() for x in whole]
        assert [own.decode(x) for x in got] == some
        own.forget()
        assert not own.known and not own.number and not own.filled


def test_every_occurrence_is_drawn_anew():
    """Not one of a few for the whole corpus: segmentations come up as often as with coins of a generator."""
    own, rng = sc.Codec(PATH, 0.1), random.Random(8)
    for word in ("the", "understanding", "encyclopaedia"):
        coins = [sum((rng.random() < 0.1) << i for i in range(64)) for _ in range(2000)]
        want = Counter(own._ids(f" {word}", 0, m) for m in coins)
        text = " ".join([word] * 2000)
        units = [own.encode(word, k).tobytes() for k in range(2000)]
        for got in (Counter(units), Counter(map(bytes, own_units(own, text, 7)))):
            assert all(abs(got[x] - want[x]) < 100 for x in want | got), word
            assert len(got) > (4 if len(word) > 5 else 1), word
        assert list(own.encode(text, 7)) == list(sc.Codec(PATH, 0.1).encode(text, 7))


def own_units(own, text, key):
    """The ids of each unit of a text of units that begin with a space."""
    ids = own.encode(text, key)
    cuts = [i for i, x in enumerate(ids) if own.bytes_of[x].startswith(b" ")]
    return [ids[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], None], strict=True)]


def test_masks_as_one_by_one():
    own, rng = sc.Codec(PATH, 0.1), random.Random(3)
    units = [u for x in texts() for u in own.units(f" {x}") if len(u) <= sc._MASKED]
    masks = [rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64) for _ in units]
    assert own._encode_units(units, [], masks) == [own._ids(u, 0, m) for u, m in zip(units, masks, strict=True)]


def test_long_and_short_agendas_agree():
    own = sc.Codec(PATH, 0.15)
    for x in texts():
        for v in range(sc.VARIANTS):
            assert own._short(x[:300], v) == own._long(x[:300], v)


@pytest.mark.parametrize("dropout", [0.0, 0.15])
def test_many_units_at_once_as_one_by_one(dropout):
    own = sc.Codec(PATH, dropout)
    units = {u for x in texts() for u in own.units(f" {x}")}
    for v in range(sc.VARIANTS):
        assert own.learn(units, v) == {u: own.encode_unit(u, v) for u in units}


def test_documents(spark):
    rows = [(1, "Two  words\n", "clash"), (2, None, ""), (2, None, None), (3, "", ""), (4, "w" * 200_000, ""), (None, "null id", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sc.encode_documents(df, PATH)
    got = {r.doc_id: r for r in out.collect()}
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in got.values())
    assert got[2].n_pieces == got[2].n_bytes == 0
    back = {r.doc_id: r.text for r in sc.decode_documents(out, PATH).collect()}
    assert back == {r[0]: r[1] or "" for r in rows}
    assert sc.encode_documents(df.limit(0), PATH).count() == 0
