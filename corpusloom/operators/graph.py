"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.lineage import Scratch

#: Values that more than HEAVY rows have, the MOST most frequent of them, meet their parent in SALTS tasks.
SALTS, HEAVY, MOST = 32, 10_000, 1000


def _replace(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Values of the column are replaced by their parent where they have one. parents: node, up. Only the parents of frequent values, as
    the root of a large component, are listed once for each of SALTS salts: a copy of all of them for every salt would be what the join sorts."""
    frequent = rows.groupBy(F.col(column).alias("node")).agg(F.count("*").alias("n")).filter(F.col("n") > HEAVY).orderBy(F.desc("n")).limit(MOST)
    heavy = F.array(*[F.lit(r.node) for r in frequent.collect()]).cast("array<long>")
    salt = F.when(F.array_contains(heavy, F.col(column)), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    out = rows.withColumn("salt", salt).join(_salted(parents, heavy).withColumnRenamed("node", column), [column, "salt"], "left")
    return out.withColumn(column, F.coalesce("up", column)).select(*rows.columns)


def _salted(parents: DataFrame, heavy: Column) -> DataFrame:
    """node, up, salt: once for each salt where the node is heavy, else once."""
    salts = F.when(F.array_contains(heavy, F.col("node")), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return parents.select("node", "up", F.explode(salts).alias("salt"))


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (longs). Returns node, label: the smallest node that is reachable, for every node with an edge.

    Each round gives every node its least neighbour as parent, if that is less, and replaces parents by their parents until all are roots; an
    edge between two nodes then becomes one between their roots. Every node that still has an edge is a root with another below it or not a root, so that the
    roots are at most half of the nodes; the least node of a component stays. What a round makes is written to the shared folder.
    """
    scratch = Scratch(edges.sparkSession)
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = scratch.cut(edges.filter("a <> b").select(ends.alias("e")).select("e.a", "e.b").distinct())
    labels = scratch.cut(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while not both.isEmpty():
        parents = scratch.cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("up")))
        while True:
            jumped = _replace(parents.select("node", F.col("up").alias("p"), F.col("up").alias("was")), "p", parents)
            jumped = scratch.cut(jumped.select("node", F.col("p").alias("up"), (F.col("p") < F.col("was")).alias("moved")))
            old, parents = parents, jumped
            scratch.free(old)
            if parents.filter("moved").isEmpty():
                break
        old = (labels, both)
        labels = scratch.cut(_replace(labels, "label", parents))
        both = scratch.cut(_replace(_replace(both, "a", parents), "b", parents).filter("a <> b").distinct())
        scratch.free(parents, *old)
    return labels
