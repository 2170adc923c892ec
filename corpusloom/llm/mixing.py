"""Mixing sources to target weights by capped water-filling.

Each source asks for its weight's share of the total; one that would pass max_epochs times its
size is clamped there, and what it leaves over is reshared by weight among the others, until none
is above. A source of r = target / size is sampled as floor(r) whole repetitions of each of its
documents and one fractional repetition: documents in the order of a seeded hash until the
rest of the target is used up.

The order is never sorted as a whole: a source's documents fall into BUCKETS buckets by the first digits of the
hash, and only sums of buckets are accumulated over a source (BUCKETS rows at most for any
source). Joins are on (source, bucket), so that a source with a third of all rows is spread over BUCKETS keys.

A null source is a source, ordered last; null texts have size 0 and take 0 words. Equal rows are told apart by nothing, so
any of them may take the rest of a target; the multiset of rows is the same in every run. Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_CLASS, cut

MAX_EPOCHS, SEED, HEX = 3, 42, 3
BUCKETS = 16**HEX


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds _rank, from 0 by code point with null last: rank within a range partition plus the rows of those before."""
    parts = cut(sources.repartitionByRange(8, F.col("_source").asc_nulls_last()).withColumn("_p", F.spark_partition_id()))
    own = Window.partitionBy("_p").orderBy(F.col("_source").asc_nulls_last())
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")  # 8 rows
    return parts.withColumn("_rank", F.row_number().over(own) - 1).join(F.broadcast(offsets), "_p").withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_p", "_before")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources: _source, source_size. Adds target. Each round clamps all sources over their cap at once; one number a round reaches the driver."""
    w = F.get(F.array(*[F.lit(x).cast("long") for x in weights]), (F.col("_rank") % len(weights)).cast("int"))
    table = cut(_ranked(sources).withColumn("_weight", w).withColumn("_cap", F.col("source_size") * max_epochs))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    free, rest = F.lit(True), None
    left = weight = 0
    while True:
        clamped, weight = table.agg(F.coalesce(F.sum(F.when(~free, F.col("_cap"))), F.lit(0)), F.coalesce(F.sum(F.when(free, F.col("_weight"))), F.lit(0))).first()
        left = total - clamped
        if not weight:
            break
        above = free & (F.col("_weight") * F.lit(left).cast("double") / F.lit(weight) > F.col("_cap"))
        if not table.filter(above).limit(1).count():
            break
        # a source above at this level is above at every higher one
        free = F.col("_weight") * F.lit(left).cast("double") / F.lit(weight) <= F.col("_cap")
    share = F.col("_weight") * F.lit(left).cast("double") / F.lit(max(weight, 1))
    return table.withColumn("target", F.when(free, share).otherwise(F.col("_cap").cast("double"))).drop("_rank", "_weight", "_cap", "_p")


def bucket_plan(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: _source, size, _bucket of each document. A row for each (_source, _bucket): source_size, target,
    _whole repetitions, _left words of the fractional repetition when the bucket begins."""
    by = cut(sizes.groupBy("_source", "_bucket").agg(F.sum("size").alias("_sum")))
    sources = water_fill(by.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, max_epochs)
    goal, size = F.floor(F.col("target") + 0.5).cast("long"), F.greatest(F.col("source_size"), F.lit(1))
    sources = sources.withColumn("_goal", goal).withColumn("_whole", F.expr("_goal div greatest(source_size, 1)"))
    sources = sources.withColumn("_extra", F.col("_goal") - F.col("_whole") * size).drop("_goal")
    run = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    out = by.withColumn("_before", F.coalesce(F.sum("_sum").over(run), F.lit(0)))
    # names that differ, as _source may be null
    out = out.join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    return out.withColumn("_left", F.col("_extra") - F.col("_before")).drop("_before", "_extra", "_sum")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """_row (the row as it is), _id, _source, size, _key, _bucket."""
    key = order_key(F.col(id_col), seed)
    return docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), n_words(F.col(text_col)).alias("size"), key.alias("_key"), F.substring(key, 1, HEX).alias("_bucket"))


def _in_order() -> Column:
    """Words of the fractional repetition that are left before a row."""
    run = Window.partitionBy("_bucket", "_source").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return F.col("_left") - F.coalesce(F.sum("size").over(run), F.lit(0))


def _on_bucket(docs: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.withColumnsRenamed({"_source": "_s", "_bucket": "_b"})
    return docs.join(p, (F.col("_bucket") == F.col("_b")) & F.col("_source").eqNullSafe(F.col("_s"))).drop("_s", "_b")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, size, source_size, target, taken for each row. The document at the end of the fractional repetition is taken in part, so that a source's taken words are its rounded target."""
    sizes = cut(_keyed(docs, id_col, text_col, source_col, seed).drop("_row"))
    rows = _on_bucket(sizes, bucket_plan(sizes, weights, max_epochs))
    part = F.least(F.greatest(_in_order(), F.lit(0)), F.col("size"))
    return rows.select(F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("_whole") * F.col("size") + part).alias("taken"))


def mix_rows(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix, each as often as it is taken. Texts stay whole: the document at the end of the fractional
    repetition is in if at least half of it is taken, and so are rows equal to it. Documents without words aren't taken."""
    sizes = cut(_keyed(docs, id_col, text_col, source_col, seed).drop("_row"))
    rows = _on_bucket(sizes, bucket_plan(sizes, weights, max_epochs))
    at = F.struct("_key", "_id", "size")
    rows = rows.withColumn("_in", F.when(2 * _in_order() >= F.col("size"), at))
    cuts = rows.groupBy("_bucket", "_source").agg(F.first("_whole").alias("_whole"), F.max("_in").alias("_last"))
    full = _on_bucket(_keyed(docs, id_col, text_col, source_col, seed), cuts)
    times = F.when(F.col("size") > 0, F.col("_whole") + F.coalesce((at <= F.col("_last")).cast("long"), F.lit(0))).otherwise(F.lit(0))
    copies = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
    return full.select("_row", copies.alias("_n")).select("_row.*")
