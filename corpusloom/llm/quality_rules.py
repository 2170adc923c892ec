"""Quality rules with risk-controlled thresholds.

Five signals of a text (share of symbols, of equal lines and of repeated three-word windows, mean
word length, its shortfall) have fixed grids of cutoffs. Documents with a label are split by a
hash. One half (fit) puts the cutoffs of a stratum that reject bad documents more often than good ones into
one sequence, those first that reject few good ones for each bad one. The other half (holdout) tests, in this sequence, the rule that joins the cutoffs up to each:
if it would reject k of the n good holdout documents, the exact binomial tail P(Bin(n, alpha) <= k) bounds the
chance of seeing so few if the true false-rejection rate were over alpha. The first test that isn't passed at
delta / strata ends the sequence. As the sequence is fixed before the holdout is seen, no
division by the number of cutoffs is needed (fixed-sequence testing): with probability 1 - delta (Bonferroni over strata), in every stratum the certified cutoffs together reject at most alpha of
good documents that the base rules keep. A stratum with too few labels (228 good holdout documents, with four others) gets none, and only the base rules act there.

Strata are languages; null is a stratum of its own. At most MAX_STRATA strata, those with the most
labels, have cutoffs of their own, the others share one: this bounds the table that is
broadcast. Null texts have no words and fail the base rule. Repeated rows are judged each.
Of several labels of a document the lowest quality counts; labels with a null quality don't count.
Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACES, cut, let, stored, words_of

ALPHA, DELTA, MAX_STRATA = 0.02, 0.05, 1024
#: A text is rejected if the signal, an integer, is over the cutoff.
GRIDS: dict[str, tuple[int, ...]] = {
    "symbols_pm": (400, 300, 200, 150, 100, 70, 50, 30),
    "dup_lines_pm": (700, 500, 400, 300, 200, 150, 100),
    "repeats_pm": (450, 400, 350, 300, 250, 200, 150, 100),
    "word_len_pm": (20000, 15000, 12000, 10000, 9000, 8000),
    "word_len_short_pm": (-1500, -2000, -2500, -3000, -3500, -4000),
}
SYMBOLS = "#*$%&|<>"


def _repeat_words(words: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.get(s, j)["h"] == x["h"]
        twin = F.filter(s, lambda x, j: F.coalesce(F.when(j > 0, same(x, j - 1)), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))
        return let(F.sort_array(F.transform(twin, lambda x: x["i"])), covered)

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    return F.when(n < 3, F.lit(0)).otherwise(let(F.sort_array(windows), repeated)).cast("long")


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """_row (the row as it is) with n_words, word_chars, n_symbols, n_lines (those with a word), n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = lambda drop: F.length(F.translate(text, drop, ""))
    counts = let(words_of(F.col(text_col)), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    distinct = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d")))
    out = docs.select(F.struct("*").alias("_row"), counts.alias("_w"), distinct.alias("_l"), length(SPACES).cast("long").alias("word_chars"), (F.length(text) - length(SYMBOLS)).cast("long").alias("n_symbols"))
    n, r = F.col("_w.n"), F.col("_w.r")
    return out.select("_row", n.alias("n_words"), "word_chars", "n_symbols", F.col("_l.n").alias("n_lines"), (F.col("_l.n") - F.col("_l.d")).alias("n_dup_lines"), r.alias("n_repeat_words"), ((n < 50) | (100 * r > 50 * n)).alias("base_failed"))


def _signals() -> Column:
    per = lambda x, n: F.expr(f"1000 * {x} div greatest({n}, 1)")
    return F.array(per("n_symbols", "n_words"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("word_chars", "n_words"), -per("word_chars", "n_words"))


def _lgamma(x: Column) -> Column:
    """By Stirling's series at x + 10."""
    y = x + 10
    low = F.lit(0.0)
    for i in range(10):
        low = low + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - low


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k < n p, else 1: the term at k times a sum of ratios that fall quickly; what is left out is below 1e-16 of it."""
    k, n = k.cast("double"), n.cast("double")
    at_k = F.exp(_lgamma(n + 1) - _lgamma(k + 1) - _lgamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    low = F.greatest(F.lit(0.0), k - 60 - 12 * F.sqrt(n * (p * (1 - p))))
    start = F.struct(F.lit(1.0).alias("s"), F.lit(1.0).alias("t"))

    def step(a: Column, i: Column) -> Column:
        t = a["t"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct((a["s"] + t).alias("s"), t.alias("t"))

    down = F.transform(F.sequence(F.lit(0), F.ceil(k - low).cast("int")), lambda i: k - i)
    total = F.aggregate(F.filter(down, lambda i: i >= 1), start, step, lambda a: a["s"])
    return F.when(k < n * p, F.least(F.lit(1.0), at_k * total)).otherwise(F.lit(1.0))


def certified_cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", stratum_col: str = "lang") -> DataFrame:
    """_stratum and one column for each signal, null where no cutoff is certified; at most MAX_STRATA + 1 rows."""
    lab = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_good"))
    own = counts.filter(~F.col("base_failed")).select(F.col(f"_row.{id_col}").alias("_id"), F.coalesce(F.concat(F.lit("="), F.col(f"_row.{stratum_col}")), F.lit("null")).alias("_stratum"), _signals().alias("_x"))
    fold = F.substring(F.md5(F.concat(F.lit("quality:"), F.col("_id").cast("string"))), 1, 1) < "8"
    rows = cut(own.join(lab, "_id").select("_stratum", (F.col("_good") == 1).alias("good"), fold.alias("hold"), "_x"))
    good, hold = F.col("good"), F.col("hold")
    large = cut(rows.groupBy("_stratum").agg(F.count_if(good & hold).alias("most")).orderBy(F.desc("most"), "_stratum").limit(MAX_STRATA).select("_stratum"))
    tests = large.count() + 1
    rows = rows.join(F.broadcast(large.withColumn("_own", F.lit(True))), "_stratum", "left").withColumn("_stratum", F.when(F.col("_own"), F.col("_stratum")).otherwise(F.lit("other")))
    grid = F.array(*[F.struct(F.lit(i).alias("s"), F.lit(c).cast("long").alias("c")) for i, cs in enumerate(GRIDS.values()) for c in cs])
    hit = F.get(F.col("_x"), F.col("g.s")) > F.col("g.c")
    fit = rows.filter(~hold).select("_stratum", "good", "_x", F.explode(grid).alias("g")).groupBy("_stratum", "g").agg(F.count_if(good).alias("fg"), F.count_if(good & hit).alias("fgr"), F.count_if(~good).alias("fb"), F.count_if(~good & hit).alias("fbr"))
    useful = fit.filter(F.col("fbr") * F.col("fg") > F.col("fgr") * F.col("fb"))
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy((F.col("fgr") + 1) / (F.col("fbr") + 1), "g.s", F.desc("g.c")))  # the grid at most
    sequence = cut(useful.select("_stratum", "g.s", "g.c", place.alias("at")))
    known = sequence.groupBy("_stratum").agg(F.collect_list(F.struct("at", "s", "c")).alias("seq"))
    first = F.array_min(F.transform(F.filter("seq", lambda g: F.get(F.col("_x"), g["s"]) > g["c"]), lambda g: g["at"]))
    seen = rows.filter(good & hold).join(F.broadcast(known), "_stratum").groupBy("_stratum", first.alias("at")).agg(F.count("*").alias("m"))
    total = seen.groupBy("_stratum").agg(F.sum("m").alias("n"))
    so_far = Window.partitionBy("_stratum").orderBy("at")
    tried = sequence.join(seen, ["_stratum", "at"], "left").join(total, "_stratum").withColumn("k", F.sum(F.coalesce("m", F.lit(0))).over(so_far))
    ok = binomial_tail(F.col("k"), F.col("n"), alpha) <= delta / tests
    passed = tried.withColumn("_ok", F.min(ok).over(so_far)).filter("_ok")
    return passed.groupBy("_stratum").agg(*[F.min(F.when(F.col("s") == i, F.col("c"))).alias(s) for i, s in enumerate(GRIDS)])


def judge(counts: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """Adds kept: false where a base rule or a certified cutoff of the row's stratum rejects. cutoffs has a bounded number of rows."""
    own = F.coalesce(F.concat(F.lit("="), F.col(f"_row.{stratum_col}")), F.lit("null"))
    named = cutoffs.select(*[F.col(c).alias(f"_{c}" if c[0] != "_" else c) for c in cutoffs.columns])
    over = [F.coalesce(F.get(_signals(), F.lit(i)) > F.col(f"_{s}"), F.lit(False)) for i, s in enumerate(GRIDS)]
    hit = over[0]
    for x in over[1:]:
        hit = hit | x
    known = [r[0] for r in cutoffs.select("_stratum").collect()]  # at most MAX_STRATA + 1 names
    stratum = F.when(own.isin(known), own).otherwise(F.lit("other")) if known else own
    out = counts.withColumn("_stratum", stratum).join(F.broadcast(named), "_stratum", "left")
    return out.withColumn("kept", ~F.col("base_failed") & ~hit).drop("_stratum", *[f"_{s}" for s in GRIDS])


def kept_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", stratum_col: str = "lang") -> DataFrame:
    """The rows of docs that are kept. Rows and counts are stored once, so that the texts are gone through once and are never shuffled."""
    counts = stored(text_counts(docs, text_col))
    cutoffs = cut(certified_cutoffs(counts, labels, id_col=id_col, stratum_col=stratum_col))
    return judge(counts, cutoffs, stratum_col).filter("kept").select("_row.*")
