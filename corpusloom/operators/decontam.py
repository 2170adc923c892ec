"""Overlap with benchmark texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.lineage import cut

#: Up to so many benchmark n-grams go to all tasks; more are joined by hash.
BROADCAST = 1_000_000


def ngrams(text: Column, n: int) -> Column:
    """Distinct lower-cased word n-grams; none if there are fewer words."""
    join = lambda w, i: F.array_join(F.slice(w, i, F.lit(n)), " ")
    return tx.let(tx.words(F.lower(text)), lambda w: F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: join(w, i)))).otherwise(F.array().cast("array<string>")))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, seq: str = "seq", text: str = "text") -> DataFrame:
    """seq, n_hits: distinct n-grams that also stand in a benchmark text. They meet by hash, then as they are. The documents' n-grams
    aren't shuffled unless the benchmark has more than BROADCAST."""
    grams = lambda df, t: df.select("*", F.explode(ngrams(F.col(t), n)).alias("gram"))
    known = grams(benchmark.select("text"), "text").select(F.xxhash64("gram").alias("h"), "gram").distinct().withColumnRenamed("gram", "known")
    known = cut(known)
    if known.limit(BROADCAST + 1).count() <= BROADCAST:
        known = F.broadcast(known)
    own = grams(docs.select(F.col(seq).alias("seq"), F.col(text).alias("_t")), "_t").select("seq", "gram", F.xxhash64("gram").alias("h"))
    return own.join(known, "h").filter("gram = known").groupBy("seq").agg(F.count("*").alias("n_hits"))
