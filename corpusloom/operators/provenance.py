"""Where a record comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import licence

REQUIRED = ("source_url", "crawl_ts", "license", "extractor", "pipeline_version", "seed", "filters_passed")


def make(source_url: Column, crawl_ts: Column, tag: Column, extractor: Column, version: str, seed: int, filters: list[str], now: Column) -> Column:
    """The provenance of a clean record; a time that can't be read becomes `now`, a parameter so that runs agree."""
    ts = F.coalesce(F.try_to_timestamp(crawl_ts.cast("string")), now)
    lic = licence.coerce(tag)
    return F.struct(
        source_url.alias("source_url"), ts.alias("crawl_ts"), lic.alias("license"), extractor.alias("extractor"), F.lit(version).alias("pipeline_version"), F.lit(seed).alias("seed"),
        F.array(*[F.lit(x) for x in filters]).alias("filters_passed"), F.lit(False).alias("synthetic"), F.lit(None).cast("string").alias("synth_model"), (lic != licence.UNKNOWN).alias("is_publishable"))


def problems(records: DataFrame) -> DataFrame:
    """Adds problem: the first required field that is missing, or null."""
    out = F.when(F.col("prov").isNull(), "prov")
    for name in REQUIRED:
        out = out.when(F.col(f"prov.{name}").isNull(), name)
    return records.withColumn("problem", out)
