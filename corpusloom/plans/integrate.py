"""The integrate stage: a new dataset into a base, without near-duplicates, mixed by language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions.lineage import cut
from corpusloom.operators import dedup, mix


def integrate(records: DataFrame, s: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """records: seq, _source, and any format of text; lang or meta.lang. Returns (records that stay, mix manifest)."""
    s = s or Settings()
    lang = [F.col("meta.lang")] if "meta" in records.columns else []
    lang += [F.col("lang")] if "lang" in records.columns else []
    rows = records.withColumns({"_text": mix.record_text(records.columns), "_lang": F.coalesce(*lang, F.lit("und"))})
    order = F.col("seq")
    if s.integrate.cross_dedup:
        keep = dedup.cross_keep(rows, s.clean.minhash, s.integrate.source_priority, s.seed, text="_text").filter("kept").select("seq", F.col("component").alias("_order"))
        rows, order = rows.join(keep, "seq"), F.col("_order")
    sized = cut(rows.select("seq", order.alias("_order"), F.col("_lang").alias("lang"), mix.token_count(F.col("_text")).alias("tokens")))
    chosen = cut(mix.select(sized.select(F.col("_order").alias("seq"), "lang", "tokens", F.col("seq").alias("_seq")), s.integrate.mix_ratios))
    out = records.join(chosen.select(F.col("_seq").alias("seq")), "seq")
    return out, mix.manifest(chosen, s.integrate.mix_ratios)
