"""Document predicates: language, document quality, repetition, line cleaning, lists. Each gives a reason, or null to keep."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.config import GopherQuality, ViOverrides
from corpusloom.functions import text as tx

# Word lists, letters, marks and caps that results depend on.
EN_STOPWORDS = ("the", "be", "to", "of", "and", "that", "have", "with")
VI_STOPWORDS = ("và", "là", "của", "có", "được", "cho", "những", "một", "các", "để", "trong", "người")
VI_LETTERS = "ăâđêôơưàáảãạằắẳẵặầấẩẫậèéẻẽẹềếểễệìíỉĩịòóỏõọồốổỗộờớởỡợùúủũụừứửữựỳýỷỹỵ"
BULLETS = ("•", "-", "*", "‣", "·", "◦")
TERMINALS = (".", "!", "?", '"', "'", "”", "’", "。", "…")
BAD_LINES = ("javascript", "terms of use", "cookie policy", "terms-of-use")
LINE_CAP, PARA_CAP, LINE_CHAR_CAP, PARA_CHAR_CAP = 0.30, 0.30, 0.20, 0.20
TOP_CAPS = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_CAPS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


def _starts(x: Column, marks: tuple[str, ...]) -> Column:
    return F.substring(x, 1, 1).isin(*marks)


def _ends(x: Column, marks: tuple[str, ...]) -> Column:
    return F.right(x, F.lit(1)).isin(*marks)


def _list(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def detect_language(text: Column) -> Column:
    """struct(lang, score) by letters and stop words."""
    low = F.lower(text)
    letters = F.regexp_replace(low, r"[^\p{L}]+", "")
    n = F.length(letters)
    vi = n - F.length(F.translate(letters, VI_LETTERS, ""))
    ascii_n = F.length(F.regexp_replace(letters, r"[^a-z]+", ""))
    said = lambda lang, score: F.struct(F.lit(lang).alias("lang"), F.lit(score).cast("double").alias("score"))

    def judge(x: Column) -> Column:
        some = lambda stop: F.arrays_overlap(x["w"], _list(stop))
        share = lambda k: x[k] / x["n"]
        english = F.struct(F.lit("en").alias("lang"), F.when(some(EN_STOPWORDS), 0.9).otherwise(0.65).alias("score"))
        return (
            F.when(x["n"] == 0, said("und", 0.0)).when(share("vi") > 0.02, said("vi", 0.9)).when(some(VI_STOPWORDS), said("vi", 0.7)).when(share("a") > 0.9, english).otherwise(said("und", 0.3))
        )

    facts = F.struct(n.alias("n"), vi.alias("vi"), ascii_n.alias("a"), F.array_distinct(tx.words(low)).alias("w"))
    return tx.let(facts, judge)


def language_reason(lang: Column, score: Column, allow: list[str], minimum: dict[str, float]) -> Column:
    least = F.lit(1.0)
    for k, v in minimum.items():
        least = F.when(lang == k, F.lit(v)).otherwise(least)
    return F.when(~lang.isin(*allow), F.concat(F.lit("lang_not_allowed:"), lang)).when(score < least, F.concat(F.lit("lang_score_low:"), lang))


def gopher_reason(text: Column, lang: Column, cfg: GopherQuality, vi: ViOverrides) -> Column:
    """First document-quality rule that fails."""
    symbols = F.length(text) - F.length(F.translate(text, "#…", ""))
    facts = F.struct(tx.words(text).alias("w"), tx.lines(text).alias("l"), symbols.alias("s"))

    def judge(x: Column) -> Column:
        w, ls = x["w"], x["l"]
        n, m = F.size(w), F.size(ls)
        mean = tx.total_length(w) / n
        share = lambda k, of: F.try_divide(k, of)
        no_length = (lang == "vi") & F.lit(vi.disable_word_len_rule)
        low = F.array_distinct(F.transform(w, F.lower))
        stop = F.when((lang == "vi") & F.lit(vi.use_vi_stopwords), _list(VI_STOPWORDS)).otherwise(_list(EN_STOPWORDS))
        return (
            F.when((n < cfg.min_words) | (n > cfg.max_words), F.concat(F.lit("gopher_word_count:"), n.cast("string")))
            .when(~no_length & ((mean < cfg.mean_word_length_min) | (mean > cfg.mean_word_length_max)), F.concat(F.lit("gopher_mean_word_len:"), F.format_string("%.1f", mean)))
            .when(share(x["s"], n) > cfg.symbol_to_word_ratio, F.lit("gopher_symbol_ratio"))
            .when(share(F.size(F.filter(ls, lambda y: _starts(y, BULLETS))), m) > cfg.bullet_line_ratio, F.lit("gopher_bullet_lines"))
            .when(share(F.size(F.filter(ls, lambda y: F.endswith(y, F.lit("…")))), m) > cfg.ellipsis_line_ratio, F.lit("gopher_ellipsis_lines"))
            .when(share(F.size(F.filter(w, lambda y: F.rlike(y, F.lit(tx.ALPHA)))), n) < cfg.alpha_word_ratio, F.lit("gopher_alpha_ratio"))
            .when(F.size(F.array_intersect(low, stop)) < cfg.min_stopwords, F.lit("gopher_stopwords"))
        )

    return tx.let(facts, judge)


def duplicate_parts(parts: Column) -> Column:
    """struct(n, dups, chars, dup_chars): parts, those equal to an earlier one, and their lengths; no repeats in fewer than two."""

    def count(x: Column) -> Column:
        d = F.array_distinct(x)
        n, chars = F.size(x), tx.total_length(x)
        return F.struct(n.alias("n"), (n - F.size(d)).alias("dups"), chars.alias("chars"), (chars - tx.total_length(d)).alias("dup_chars"))

    return tx.let(parts, count)


_NGRAM_FIELDS = ("chars", *[f"top_{n}" for n in TOP_CAPS], *[f"dup_{n}" for n in DUP_CAPS])
_NGRAM_SCHEMA = ", ".join(f"{x} long" for x in _NGRAM_FIELDS)
_WORDS = re.compile(r"\w+").findall


def _ngrams_of(text: str | None) -> list[int]:
    """Only repeats count, and a repeated n-gram consists of two repeated ones that are a word shorter: places whose gram occurs once are
    left behind at each length. at: those left, in order, with a number for each gram that stands for its words."""
    words = _WORDS(text or "")
    ends = [0, *accumulate(map(len, words))]
    out, at = dict.fromkeys(_NGRAM_FIELDS, 0), dict(enumerate(words))
    out["chars"] = ends[-1]
    for n in range(2, max(DUP_CAPS) + 1):
        pairs = [(i, (g, at[i + 1])) for i, g in at.items() if i + 1 in at]
        count = Counter(g for _, g in pairs)
        first, at = {}, {}
        for i, g in pairs:
            if count[g] > 1:
                at[i] = first.setdefault(g, i)
        if not at:
            break
        if n in TOP_CAPS:
            g, i = max(first.items(), key=lambda x: count[x[0]])  # the first of equals
            out[f"top_{n}"] = count[g] * (ends[i + n] - ends[i])
        if n in DUP_CAPS:
            out[f"dup_{n}"] = sum(ends[i + n] - ends[i] for i in first.values())
    return list(out.values())


def _ngram_chars(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def of(rows: list[str | None]) -> pa.Array:
        columns = list(zip(*map(_ngrams_of, rows), strict=True)) or [()] * len(_NGRAM_FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(_NGRAM_FIELDS))

    return tx.grouped(texts, of)


def ngram_chars(text: Column) -> Column:
    """Characters in all words, in all copies of the most frequent n-gram, and in one copy of each repeated n-gram."""
    return F.arrow_udf(_ngram_chars, _NGRAM_SCHEMA)(text)


def repetition_reason(text: Column, grams: Column) -> Column:
    """First repetition rule that fails; grams as of ngram_chars."""
    line, para = duplicate_parts(tx.lines(text)), duplicate_parts(tx.paragraphs(text))
    share = F.try_divide

    def parts(x: Column) -> Column:
        a, b = x["line"], x["para"]
        out = F.when(share(a["dups"], a["n"]) > LINE_CAP, F.lit("rep_dup_lines")).when(share(a["dup_chars"], a["chars"]) > LINE_CHAR_CAP, F.lit("rep_dup_line_chars"))
        return out.when(share(b["dups"], b["n"]) > PARA_CAP, F.lit("rep_dup_paras")).when(share(b["dup_chars"], b["chars"]) > PARA_CHAR_CAP, F.lit("rep_dup_para_chars"))

    later = None
    for kind, caps in (("top", TOP_CAPS), ("dup", DUP_CAPS)):
        for n, cap in caps.items():
            over, name = share(grams[f"{kind}_{n}"], grams["chars"]) > cap, F.lit(f"rep_{kind}_{n}gram")
            later = F.when(over, name) if later is None else later.when(over, name)
    return F.coalesce(tx.let(F.struct(line.alias("line"), para.alias("para")), parts), later)


def c4_clean(text: Column) -> Column:
    """struct(text, reason): lines without an end mark and lines of boiler plate go, blank ones stay."""

    def keep(raw: Column) -> Column:
        line = tx.strip(raw)
        low = F.lower(line)
        bad = F.lit(False)
        for x in BAD_LINES:
            bad = bad | F.contains(low, F.lit(x))
        return (line == "") | (~bad & _ends(line, TERMINALS))

    cleaned = tx.strip(F.array_join(F.filter(tx.raw_lines(text), keep), "\n"))
    lorem = F.contains(F.lower(text), F.lit("lorem ipsum"))
    result = tx.let(cleaned, lambda c: F.struct(c.alias("text"), F.when(c == "", "c4_all_lines_dropped").alias("reason")))
    return F.when(lorem, F.struct(text.alias("text"), F.lit("c4_lorem_ipsum").alias("reason"))).otherwise(result)


def shrunk_reason(text: Column, min_words: int) -> Column:
    n = F.size(F.filter(F.split(text, r"(?U)\s+", -1), lambda x: x != ""))
    return tx.let(n, lambda k: F.when(k < min_words, F.concat(F.lit("c4_shrunk_words:"), k.cast("string"))))


def list_like_reason(text: Column) -> Column:
    listy = lambda x: _starts(x, BULLETS) | (F.regexp_count(x, F.lit(tx.WORD)) < 3)
    return tx.let(tx.lines(text), lambda ls: F.when((F.size(ls) >= 3) & (F.size(F.filter(ls, listy)) / F.greatest(F.size(ls), F.lit(1)) > 0.5), F.lit("fineweb_list_like")))


def reason_kind(reason: Column) -> Column:
    return F.split_part(reason, F.lit(":"), F.lit(1))
