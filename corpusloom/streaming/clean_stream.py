"""The checks of single documents over a stream of records, with exact duplicates dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.config import Settings
from corpusloom.operators import dedup
from corpusloom.plans.clean import local_reasons


def clean_stream(docs: DataFrame, s: Settings | None = None, ts: str | None = None, delay: str = "1 hour") -> DataFrame:
    """docs: seq, text, source_url, and the event time ts. What passes, one of each text within the delay. Near-duplicates are left to a batch over the result."""
    rows = local_reasons(docs, s or Settings()).filter("drop_reason IS NULL").drop("drop_reason").withColumn("content_hash", dedup.content_hash(F.col("text")))
    if ts is None:
        return rows.dropDuplicates(["content_hash"])
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["content_hash"])


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes what is there, writes it as Parquet, and stops; a later call goes on behind it."""
    query = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
