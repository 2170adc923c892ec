"""Mixing languages to a share of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

RANGES = 4096


def record_text(columns: list[str]) -> Column:
    """The text of a record of any format: messages, else conversations, else instruction and output, else text."""
    parts = []
    if "messages" in columns:
        parts.append(F.when(F.col("messages").isNotNull(), F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), " ")))
    if "conversations" in columns:
        parts.append(F.when(F.col("conversations").isNotNull(), F.array_join(F.transform("conversations", lambda m: F.coalesce(m["value"], F.lit(""))), " ")))
    if "output" in columns:
        first = F.coalesce("instruction", F.lit("")) if "instruction" in columns else F.lit("")
        parts.append(F.when(F.col("output").isNotNull(), F.concat(first, F.lit(" "), F.col("output"))))
    if "text" in columns:
        parts.append(F.col("text"))
    return F.coalesce(*parts, F.lit(""))


def token_count(text: Column) -> Column:
    return F.size(tx.words(text)).cast("long")


def budgets(sized: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """lang, tokens, ratio, total, budget of the languages that have a ratio and tokens. The total is what the scarcest language allows."""
    share = F.create_map(*[F.lit(x) for kv in ratios.items() for x in (kv[0], float(kv[1]))])
    by = sized.filter(F.col("lang").isin(*ratios)).groupBy("lang").agg(F.sum("tokens").alias("tokens")).withColumn("ratio", share[F.col("lang")]).filter("ratio > 0 AND tokens > 0")
    return by.withColumn("total", F.min(F.col("tokens") / F.col("ratio")).over(Window.partitionBy(F.lit(1)))).withColumn("budget", F.col("ratio") * F.col("total"))  # a row for each ratio


def _range() -> Column:
    """Which of RANGES ranges of equal width between lo and hi a row's seq is in; in doubles, as numbers may lie far apart."""
    seq, lo, hi = (F.col(c).cast("double") for c in ("seq", "lo", "hi"))
    return F.least(F.floor((seq - lo) / (hi - lo + 1) * RANGES), F.lit(RANGES - 1)).cast("int")


def select(sized: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """sized: seq, lang, tokens. The rows of each language, in order, until its budget is reached; the last may pass it. Without any language
    of the ratios, all rows. Adds used_before.

    Sums run over RANGES ranges of seq for each language; a range that lies within the budget is taken and one past it left out by its sum alone."""
    goal = budgets(sized, ratios)
    if goal.isEmpty():
        return sized.withColumn("used_before", F.lit(None).cast("long"))
    edges = sized.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    ranged = sized.join(F.broadcast(goal.select("lang", "budget")), "lang").join(F.broadcast(edges)).withColumn("_range", _range()).drop("lo", "hi")
    sums = ranged.groupBy("lang", "_range").agg(F.sum("tokens").alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy("lang").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")  # RANGES rows for each ratio
    run = Window.partitionBy("lang", "_range").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(before), ["lang", "_range"]).filter("_before < budget")
    out = out.withColumn("used_before", F.col("_before") + F.coalesce(F.sum("tokens").over(run), F.lit(0)))
    return out.filter("used_before < budget").drop("_before", "_range", "budget")


def manifest(selected: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """lang, tokens, docs, ratio_target, ratio_real."""
    share = F.create_map(*[F.lit(x) for kv in ratios.items() for x in (kv[0], float(kv[1]))])
    by = selected.groupBy("lang").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    return by.withColumn("ratio_target", share[F.col("lang")]).withColumn("ratio_real", F.round(F.col("tokens") / F.greatest(F.sum("tokens").over(Window.partitionBy(F.lit(1))), F.lit(1)), 3))
