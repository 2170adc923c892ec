import random
import re
import unicodedata
from collections import Counter
from dataclasses import replace

import helpers as h
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions import filters, licence, pii
from corpusloom.functions import html as hx
from corpusloom.functions import text as tx

S = Settings()
ODD = ["", "   ", "é é ﬁ", "a​b﻿c\xadd", "x\r\ny z w\x85v", "² ½ x", "!!! ???", "one two", "tab\tand\x0bmore\x00\x07", "a\n\n\n\nb", "　wide　", "việt😀 nam"]


def column(spark, texts, expr):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def docs(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_words_lines_and_normalisation_as_in_plain_python(spark):
    texts = ODD + docs(spark)
    assert column(spark, texts, tx.normalize(F.col("text"))) == [h.normalize(t) for t in texts]
    clean = [h.normalize(t) for t in texts]
    assert column(spark, clean, tx.words(F.col("text"))) == [h.words(t) for t in clean]
    assert column(spark, clean, tx.lines(F.col("text"))) == [h.lines(t) for t in clean]
    assert column(spark, clean, tx.normalize(F.col("text"))) == clean  # idempotent


def test_decomposed_text_hashes_as_composed(spark):
    a, b = column(spark, ["Tiếng Việt", "Tiếng Việt"], F.sha2(tx.normalize(F.col("text")), 256))
    assert a == b


def test_language(spark):
    got = column(spark, [h.EN, h.VI, "12 34", "plain words only", "có vậy", "слова другие"], filters.detect_language(F.col("text")))
    assert [tuple(x) for x in got] == [("en", 0.9), ("vi", 0.9), ("und", 0.0), ("en", 0.65), ("vi", 0.9), ("und", 0.3)]
    reason = filters.language_reason(F.col("text"), F.lit(0.62), ["vi", "en"], {"vi": 0.6, "en": 0.65})
    assert column(spark, ["en", "vi", "fr"], reason) == ["lang_score_low:en", None, "lang_not_allowed:fr"]


@pytest.mark.parametrize(
    ("text", "lang", "reason"),
    [
        (h.EN, "en", None), (h.VI, "vi", None), (h.VI, "en", "gopher_stopwords"), ("too short", "en", "gopher_word_count:2"), ("a b " * 40, "en", "gopher_mean_word_len:1.0"),
        ("the of # # # # # # # # # # " * 30, "en", "gopher_mean_word_len:2.5"), (" ".join(["word of the # …"] * 20), "en", "gopher_symbol_ratio"), ("\n".join(["- the end of words"] * 15), "en", "gopher_bullet_lines"),
        ("\n".join(["the end of words and so many others …"] * 4 + [h.EN]), "en", "gopher_ellipsis_lines"), ("1234 5678 the of " * 20, "en", "gopher_alpha_ratio"), ("word " * 60, "en", "gopher_stopwords"),
    ],
)
def test_document_quality(spark, text, lang, reason):
    assert column(spark, [text], filters.gopher_reason(F.col("text"), F.lit(lang), S.clean.gopher_quality, S.clean.vi_overrides)) == [reason]


def test_vietnamese_overrides_can_be_switched_off(spark):
    vi = replace(S.clean.vi_overrides, use_vi_stopwords=False)
    assert column(spark, [h.VI], filters.gopher_reason(F.col("text"), F.lit("vi"), S.clean.gopher_quality, vi)) == ["gopher_stopwords"]


def test_repetition(spark):
    texts = ["same line\n" * 20, "five words in a row " * 15, h.EN, "", "a", "\n\n".join(["one para of text"] * 4), "x y x y x y " * 10]
    got = column(spark, texts, filters.repetition_reason(F.col("text"), filters.ngram_chars(F.col("text"))))
    assert got[0] == "rep_dup_lines" and got[1].startswith("rep_") and got[2:5] == [None, None, None] and got[5] == "rep_dup_lines" and got[6].startswith("rep_top_")
    for t, x in zip(texts, column(spark, texts, filters.duplicate_parts(tx.lines(F.col("text")))), strict=True):
        assert tuple(x) == h.repeated(h.lines(t))


def test_line_cleaning(spark):
    texts = ["Some Lorem Ipsum here.", "no end\nnone here", "It ends.\n\nPlease enable JavaScript.\nSee the Terms of Use.\nNo end\nIt “ends”", ""]
    got = [tuple(x) for x in column(spark, texts, filters.c4_clean(F.col("text")))]
    assert got == [(texts[0], "c4_lorem_ipsum"), ("", "c4_all_lines_dropped"), ("It ends.\n\nIt “ends”", None), ("", "c4_all_lines_dropped")]
    nav = "\n".join(["one two three four five six seven"] * 12) + "\nOne sentence stays."
    cleaned = column(spark, [nav], filters.c4_clean(F.col("text")))[0]["text"]
    assert column(spark, [cleaned], filters.shrunk_reason(F.col("text"), 50)) == ["c4_shrunk_words:3"]


def test_lists(spark):
    texts = ["- a b c\n- d e f\n* g h i\n• j k l", "one\ntwo words\nthree words here", h.EN, "- a\n- b"]
    assert column(spark, texts, filters.list_like_reason(F.col("text"))) == ["fineweb_list_like", "fineweb_list_like", None, None]


RULES = ((r"[\w.+-]+@[\w-]+\.[\w.-]+", "[EMAIL]", "email"), (r"(?<!\d)(?:\d{1,3}\.){3}\d{1,3}(?!\d)", "[IP]", "ip"), (r"(?<![\d+])(?:\+84|0)\d{9}(?!\d)", "[PHONE]", "phone_vn"), (r"(?<!\d)(?:\d{12}|\d{9})(?!\d)", "[ID]", "cccd_cmnd"))


def test_personal_data(spark):
    texts = ["mail a.b+c@x-y.example or +84912345678, id 012345678901 and 1.2.3.4", "0912345678 x0912345678 10912345678", "123456789 1234567890", "1.1.1.1 2.2.2.2.2", "nothing", "ä@ö.de", ""]
    for vi in (True, False):
        want = []
        for t in texts:
            types = []
            for p, tag, name in RULES[: 4 if vi else 2]:
                t, n = re.subn(p, tag, t)
                types += [name] * bool(n)
            want.append((t, types))
        assert [tuple(x) for x in column(spark, texts, pii.redact(F.col("text"), vi))] == want


def test_licences(spark):
    texts = ["https://creativecommons.org/licenses/by-sa/4.0", "under CC BY 4.0", "CC-BY-SA", "in the Public Domain", "cc0", "odc by", "ccby", "creativecommons.org/licenses/by/4.0/ and cc0", ""]
    assert column(spark, texts, licence.detect(F.col("text"))) == ["cc-by-sa", "cc-by", "cc-by-sa", "public-domain", "cc0", "odc-by", "unknown", "cc0", "unknown"]
    assert column(spark, ["unknown", "cc0", "mine"], licence.resolve(F.col("text"), F.lit("cc by"))) == ["unknown", "cc0", "cc-by"]


def test_html(spark):
    page = "<html><head><title> A &amp; B </title><style>p{}</style></head><body><nav>menu</nav><script>var x='<p>';</script><h1>Head</h1><p>One<br>two</p><footer>end</footer><p>Last</p></body>"
    text, title = column(spark, [page], hx.html_text(F.col("text")))[0]
    assert title == "A & B" and text.startswith("A & B") and "Last" in text and not re.search("menu|var x|end", text)
    assert column(spark, ["<p>a</p><nav>b<p>c"], hx.html_text(F.col("text")))[0]["text"] == "a"
    spa = '<div id="root"></div>' + "<script></script>" * 3
    assert column(spark, [spa, page + "x" * 600], hx.render_mode(F.col("text"))) == ["browser", "http"]
    links = '<a href="/a#f">1</a><A class=x href=\'http://o.example/b\'>2</a><a href="mailto:m">3</a><a href="c/../d">4</a><a href="#top">5</a><a href="ftp://x/y">6</a>'
    got = column(spark, [links], hx.links(F.col("text"), F.lit("https://h.example:8/p/q")))[0]
    assert got == ["https://h.example:8/a", "http://o.example/b", "https://h.example:8/p/d"]


def test_hosts_and_ids(spark):
    import hashlib

    assert column(spark, ["http://u@H.example:8/x?y", "nope", "https://a"], tx.url_host(F.col("text"))) == ["u@H.example:8", "", "a"]
    want = hashlib.sha256(b"a\x1fb\x1f").hexdigest()[:16]
    assert column(spark, ["a"], tx.stable_id(F.col("text"), F.lit("b"))) == [want]


def test_python_holds_a_group_of_texts_at_a_time():
    texts = ["x" * 100_000, None, ""] * 100 + ["y" * (3 << 20)]
    groups = []
    out = list(tx.grouped(iter([pa.array(texts), pa.array([], pa.string())]), lambda rows: groups.append(rows) or pa.array(rows, pa.string())))
    assert [t for a in out for t in a.to_pylist()] == texts
    assert max(sum(len(t or "") for t in g) for g in groups[:-2]) <= tx.GROUP_BYTES and groups[-2:] == [texts[-1:], []]


def test_only_texts_that_may_change_go_to_python(spark):
    texts = ["plain", "caf\u00e9", None, "cafe\u0301", "\u212b", "\ud55c\u1100\u1161"]
    assert column(spark, texts, tx.nfc(F.col("text"))) == [t and unicodedata.normalize("NFC", t) for t in texts]
    assert column(spark, texts, F.rlike("text", F.lit(tx.MAY_COMPOSE))) == [False, False, None, True, True, True]


def test_ngrams_as_counted_plainly():
    rng = random.Random(5)
    texts = [None, "", "a", "a a", "a " * 30, "x y x y x y"] + [" ".join(rng.choice(["a", "bb", "ccc"]) for _ in range(rng.randrange(80))) for _ in range(300)]
    got = [r for a in filters._ngram_chars(iter([pa.array(texts)])) for r in a.to_pylist()]
    for t, r in zip(texts, got, strict=True):
        w = h.words(t or "")
        want = {"chars": sum(map(len, w))}
        for n in (*filters.TOP_CAPS, *filters.DUP_CAPS):
            c = Counter(zip(*[w[i:] for i in range(n)], strict=False))
            size = lambda g: sum(map(len, g))
            g, k = max(c.items(), key=lambda x: x[1], default=((), 0))
            want |= {f"top_{n}": k * size(g) if k > 1 else 0} if n in filters.TOP_CAPS else {f"dup_{n}": sum(size(g) for g, k in c.items() if k > 1)}
        assert r == want
