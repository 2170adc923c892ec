"""Exact duplicates, near-duplicates in a scope, and near-duplicates across datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import MinHash
from corpusloom.functions import minhash
from corpusloom.functions import text as tx
from corpusloom.functions.lineage import Scratch, cut
from corpusloom.operators.graph import components


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_duplicates(docs: DataFrame, seq: str = "seq", text: str = "text") -> DataFrame:
    """Adds first_seq, the first row with the same text. Copies meet as a partial minimum and in a join that can be split, not in a window."""
    hashed = docs.withColumn("_hash", content_hash(F.col(text)))
    first = hashed.groupBy("_hash").agg(F.min(seq).alias("first_seq"))
    return hashed.join(first, "_hash").drop("_hash")


def scope_of(source_url: Column, scope: str) -> Column:
    """The host, or the url itself where it has none, behind the scope's name."""
    host = tx.url_host(source_url)
    return F.concat(F.lit(f"{scope}:"), F.when(host == "", source_url).otherwise(host))


def _bands(keys: Column) -> Column:
    return F.slice(keys, F.lit(2), F.greatest(F.size(keys) - 1, F.lit(0)))


def greedy_near_duplicates(docs: DataFrame, cfg: MinHash, seed: int = 42, seq: str = "seq", text: str = "text", scope: str = "scope") -> DataFrame:
    """seq, is_dup: whether a row shares a band with an earlier row of its scope that is itself no duplicate.

    Bands meet as sums only. In each round a row goes if one of its bands has an earlier row that stays, and stays if it is the first
    row left in all of its bands; the first undecided row is decided in every round, and in practice nearly all are at once. This equals going through the rows in order.
    Rows without words have no bands and stay.
    """
    keyed = docs.select(F.col(seq).alias("seq"), F.explode(_bands(minhash.keys(F.col(text), cfg, seed))).alias("band"), F.col(scope).alias("scope"))
    scratch = Scratch(docs.sparkSession)
    rows = scratch.cut(keyed.select("seq", F.xxhash64("scope", "band.hi").alias("k1"), F.xxhash64("scope", "band.lo").alias("k2"), F.lit(False).alias("stays")))
    # a band that only one row has decides nothing
    shared = rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = scratch.cut(rows.join(shared, ["k1", "k2"]))
    gone = rows.select("seq").limit(0)
    while True:
        per = rows.groupBy("k1", "k2").agg(F.min("seq").alias("first"), F.min(F.when(F.col("stays"), F.col("seq"))).alias("kept"))
        seen = rows.join(per, ["k1", "k2"]).groupBy("seq").agg(F.first("stays").alias("stays"), F.max(F.coalesce(F.col("kept") < F.col("seq"), F.lit(False))).alias("goes"), F.min(F.col("first") == F.col("seq")).alias("leads"))
        state = scratch.cut(seen.select("seq", (F.col("stays") | F.col("leads")).alias("now"), (~F.col("stays") & F.col("goes")).alias("goes")))
        gone = gone.unionByName(state.filter("goes").select("seq"))
        if state.filter("NOT now AND NOT goes").isEmpty():
            break
        old, rows = rows, scratch.cut(rows.drop("stays").join(state.filter("NOT goes").select("seq", F.col("now").alias("stays")), "seq"))
        scratch.free(old)
    marked = gone.withColumn("is_dup", F.lit(True))
    return docs.select(F.col(seq).alias("seq")).join(marked, "seq", "left").select("seq", F.coalesce("is_dup", F.lit(False)).alias("is_dup"))


def _to_first(keyed: DataFrame) -> DataFrame:
    """a, b: rows b with the first row a of the same key, for all but that. keyed: b, k of hi and lo."""
    flat = keyed.select("b", "k.hi", "k.lo")
    first = flat.groupBy("hi", "lo").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return flat.join(first, ["hi", "lo"]).select("a", "b").filter("a <> b")


def near_components(docs: DataFrame, cfg: MinHash, seed: int = 42, seq: str = "seq", text: str = "text") -> DataFrame:
    """seq, component: the least row reachable over shared bands. Rows of a band are linked to its first, which reaches the same rows as all pairs.

    Rows with the same signature share all bands: only the first of them brings its bands, and the others are linked to it."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.cut(docs.select(F.col(seq).alias("b"), minhash.keys(F.col(text), cfg, seed).alias("keys"))).filter(F.size("keys") > 0)
    alike = scratch.cut(_to_first(rows.select("b", F.col("keys")[0].alias("k"))))
    leaders = rows.join(alike.select("b"), "b", "left_anti")
    edges = alike.unionByName(_to_first(scratch.cut(leaders.select("b", F.explode(_bands(F.col("keys"))).alias("k"))))).distinct()
    labels = components(edges)
    return docs.select(F.col(seq).alias("seq")).join(labels, F.col("seq") == F.col("node"), "left").select("seq", F.coalesce("label", "seq").alias("component"))


def source_rank(source: Column, priority: list[str]) -> Column:
    """Place in the priority list, unlisted sources last."""
    at = F.array_position(F.array(*[F.lit(s) for s in priority]), source)
    return F.when(F.coalesce(at, F.lit(0)) == 0, len(priority)).otherwise(at - 1).cast("int")


def cross_keep(docs: DataFrame, cfg: MinHash, priority: list[str], seed: int = 42, seq: str = "seq", text: str = "text", source: str = "_source") -> DataFrame:
    """seq, component, rank, kept: of each component the row of the best source stays, the first of equals."""
    found = near_components(docs, cfg, seed, seq, text).join(docs.select(F.col(seq).alias("seq"), source_rank(F.col(source), priority).alias("rank")), "seq")
    best = found.groupBy("component").agg(F.min(F.struct("rank", "seq")).alias("best"))
    return found.join(best, "component").select("seq", "component", "rank", (F.col("seq") == F.col("best.seq")).alias("kept"))
