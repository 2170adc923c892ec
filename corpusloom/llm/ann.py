"""Nearest neighbours with a hierarchical k-means tree and best-bin-first search.

The tree is fitted on a sample (the least rows by a hash of their id; one of SHARE rows, but no fewer than SAMPLE and no more than MOST, so that leaves grow in number with the table up to
a size that can be sent to all tasks); every row is indexed, by descending to a leaf. A query takes nodes
from a priority queue by the distance of their centre and visits the first `visits` leaves it meets. How many that are is calibrated: for
CALIBRATION rows outside the sample (if there are so many) the true neighbours are found by brute force over all rows, and visits are widened until TARGET of these lie in visited leaves.
Each leaf has the count of its rows and the radius around its centre. A query leaves out a leaf whose nearest possible row lies behind the farthest possible of k rows of other leaves.

Of equal vectors only the k + 1 least ids are indexed: a query wants the k nearest with ties to the least id, itself left out, so no other can be in a
result. TOGETHER neighbouring leaves are one group, cut into blocks of rows and of queries; a pair of blocks is compared by one matrix product, and only the k best of each, with their exact distances, go on.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose length isn't the usual one of
the sample. Rows with a null id take no part. Repeated rows count once; an id with several vectors has its smallest distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import cut

SAMPLE, SHARE, MOST, CALIBRATION, TARGET, SEED = 20_000, 32, 200_000, 300, 0.95, 42
BRANCHES, LEAF, ROUNDS, SALTS = 8, 64, 8, 16
ROWS, QUERIES, TOGETHER = 4096, 1024, 8


@dataclass
class Tree:
    """Nodes in order of creation; children[i] is empty for a leaf, leaf[i] its number."""

    centers: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest child on every level."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not len(kids):
                out[rows] = self.leaf[node]
                continue
            near = squares(x[rows], self.centers[kids]).argmin(axis=1)
            todo += [(int(kids[j]), part) for j in range(len(kids)) if len(part := rows[near == j])]
        return out

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                yield int(self.leaf[node])
                continue
            for d, kid in zip(squares(q[None], self.centers[kids])[0], kids, strict=True):
                heapq.heappush(queue, (float(d), int(kid)))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, for choosing among centres only."""
    return (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each row."""
    c = x[rng.choice(len(x), k, replace=False)]
    near = np.zeros(len(x), np.int64)
    for _ in range(ROUNDS):
        near = squares(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return near


def fit(x: np.ndarray, seed: int = SEED, branches: int = BRANCHES, leaf_size: int = LEAF) -> Tree:
    rng = np.random.default_rng(seed)
    centers, children, leaf, todo, leaves = [x.mean(axis=0)], [np.empty(0, np.int64)], [-1], [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) > leaf_size:
            near = kmeans(x[rows], branches, rng)
            parts = [p for j in range(branches) if len(p := rows[near == j])]
        if len(parts) < 2:  # small, or equal vectors only
            leaf[node], leaves = leaves, leaves + 1
            continue
        children[node] = np.arange(len(centers), len(centers) + len(parts))
        for p in parts:
            todo.append((len(centers), p))
            centers.append(x[p].mean(axis=0))
            children.append(np.empty(0, np.int64))
            leaf.append(-1)
    return Tree(np.array(centers), children, np.array(leaf))


def nearest(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, k: int, may: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, place of the row and exact Euclidean distance of the k nearest rows of each query (ids: own) with another id, and of any others as near. may: which pairs count.

    A matrix product tells which may be among them, up to its rounding; their distances are then computed from the differences."""
    empty = np.empty(0, np.int64)
    if not len(ids) or not len(own):
        return empty, empty, np.empty(0)
    about = squares(q, x)
    about[own[:, None] == ids] = np.inf
    if may is not None:
        about[~may] = np.inf
    k = min(len(ids), k * int(np.unique(ids, return_counts=True)[1].max()))  # an id may have several vectors
    last = np.partition(about, k - 1, axis=1)[:, k - 1]
    slack = 1e-10 * ((q * q).sum(axis=1).max() + (x * x).sum(axis=1).max())
    at, row = np.nonzero((about <= last[:, None] + slack) & np.isfinite(about))
    d = x[row] - q[at]
    return at, row, np.sqrt((d * d).sum(axis=1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def _first_of_equal(rows: DataFrame, k: int) -> DataFrame:
    """Of rows with equal vectors those with the k least ids: first for each salt, then of all, so that no task gets a large group of equals."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    for key in (["v", "salt"], ["v"]):
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
        rows = rows.withColumn("salt", salt).withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r")
    return rows.drop("salt")


def _brute(rows: DataFrame, queries: list, k: int, dim: int) -> DataFrame:
    """q, leaf of the k nearest rows of each query: k best of every batch, then of all."""
    own, qs = np.array([i for i, _ in queries]), np.array([v for _, v in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
            at, row, d = nearest(ids, _matrix(b.column(1), dim), own, qs, k)
            yield pa.RecordBatch.from_arrays([pa.array(own[at], pa.int64()), pa.array(d), pa.array(ids[row], pa.int64()), pa.array(leaf[row], pa.int32())], ["q", "d", "n", "leaf"])

    found = rows.select("id", "v", "leaf").mapInArrow(run, "q long, d double, n long, leaf int").groupBy("q", "n").agg(F.min_by(F.struct("d", "leaf"), "d").alias("f")).select("q", "n", "f.d", "f.leaf")
    return found.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy("d", "n"))).filter(F.col("_r") <= k).select("q", "leaf")


def calibrate(tree: Tree, queries: list, truth: list, target: float = TARGET) -> int:
    """The least number of visits at which the share of true neighbours in visited leaves is at least target."""
    rank = {i: {leaf: r for r, leaf in enumerate(tree.visit(np.array(v)))} for i, v in queries}
    at = sorted(rank[q][leaf] for q, leaf in truth)
    return at[min(len(at) - 1, int(np.ceil(target * len(at))) - 1)] + 1 if at else tree.leaves


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", sample: int | None = None, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) for the rows where is_query holds."""
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("q")).filter(F.col("id").isNotNull() & valid(F.col("v")))
    rows = cut(rows.groupBy("id", "v").agg(F.max("q").alias("q")))
    sample = sample or max(SAMPLE, min(MOST, rows.count() // SHARE))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample + CALIBRATION).select("id", "v").collect()  # at most MOST + CALIBRATION vectors
    if not picked:
        return spark.createDataFrame([], out_schema)
    sizes = [len(r.v) for r in picked]
    dim = max(set(sizes), key=lambda n: (sizes.count(n), n))
    rows = rows.filter(F.size("v") == dim)
    usual = [r for r in picked if len(r.v) == dim]
    tree = fit(np.array([r.v for r in usual[:sample]], np.float64))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tree.assign(_matrix(b.column(1), dim)), pa.int32())], ["id", "v", "leaf"])

    vector = vectors.schema[vector_col].dataType.simpleString()
    indexed = cut(_first_of_equal(rows.select("id", "v"), k + 1).mapInArrow(index, f"id long, v {vector}, leaf int"))
    cal = [(r.id, [float(x) for x in r.v]) for r in usual[-CALIBRATION:]]
    truth = [(r.q, r.leaf) for r in _brute(indexed, cal, k, dim).collect()]  # CALIBRATION * k rows
    visits = calibrate(tree, cal, truth, target)

    center = np.array([tree.centers[i] for i in np.argsort(np.where(tree.leaf < 0, len(tree.leaf), tree.leaf), kind="stable")[: tree.leaves]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = b.column(2).to_numpy()
            d = _matrix(b.column(1), dim) - center[leaf]
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(np.sqrt((d * d).sum(axis=1)))], ["leaf", "d"])

    known = indexed.select("id", "v", "leaf").mapInArrow(measure, "leaf int, d double").groupBy("leaf").agg(F.count("*").alias("n"), F.max("d").alias("r")).collect()  # a row for each leaf
    size, radius = np.zeros(tree.leaves, np.int64), np.zeros(tree.leaves)
    for r in known:
        size[r.leaf], radius[r.leaf] = r.n, r.r * (1 + 1e-9)
    groups = -(-tree.leaves // TOGETHER)
    several = indexed.groupBy("id").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]  # vectors that one id has

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import islice

        for b in batches:
            leaves = []
            for q in _matrix(b.column(1), dim):
                d = np.sqrt(((center - q) ** 2).sum(axis=1))
                by = np.argsort(d + radius, kind="stable")
                enough = min(int(np.searchsorted(np.cumsum(size[by]), several * k + 1)), len(by) - 1)
                reach = (d + radius)[by[enough]]  # k rows other than the query itself are no farther
                leaves.append([leaf for leaf in islice(tree.visit(q), visits) if size[leaf] and d[leaf] - radius[leaf] <= reach])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaves, pa.list_(pa.int32()))], ["id", "v", "leaves"])

    planned = rows.filter("q").select("id", "v").mapInArrow(plan, f"id long, v {vector}, leaves array<int>").select("id", "v", "leaves", F.explode(F.array_distinct(F.transform("leaves", lambda x: (x / TOGETHER).cast("int")))).alias("g"))
    asked = cut(planned.withColumn("leaves", F.filter("leaves", lambda x: (x / TOGETHER).cast("int") == F.col("g"))))
    found = indexed.withColumn("g", (F.col("leaf") / TOGETHER).cast("int"))
    blocks = lambda df, size: {r.g: -(-r.n // size) for r in df.groupBy("g").agg(F.count("*").alias("n")).collect()}  # noqa: E731  a number for each group of leaves
    row_blocks, query_blocks = blocks(found, ROWS), blocks(asked, QUERIES)
    count = lambda n: F.coalesce(F.get(F.lit([n.get(i, 0) for i in range(groups)]), F.col("g")), F.lit(0))
    every = lambda n: F.explode(F.filter(F.sequence(F.lit(0), F.greatest(count(n) - 1, F.lit(0))), lambda i: i < count(n)))
    own = lambda n: F.pmod(F.xxhash64("id"), F.greatest(count(n), F.lit(1))).cast("int")
    left = asked.select("g", own(query_blocks).alias("qb"), every(row_blocks).alias("rb"), "id", "v", "leaves")
    right = found.select("g", every(query_blocks).alias("qb"), own(row_blocks).alias("rb"), "id", "v", "leaf")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def compare(queries: pa.Table, found: pa.Table) -> pa.Table:
        if not queries.num_rows or not found.num_rows:
            return schema.empty_table()
        ids, q = found.column("id").to_numpy(), queries.column("id").to_numpy()
        leaf, lists = found.column("leaf").to_numpy() % TOGETHER, queries.column("leaves").combine_chunks()
        visited = np.zeros((len(q), TOGETHER), bool)
        visited[np.repeat(np.arange(len(q)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy() % TOGETHER] = True
        at, row, d = nearest(ids, _matrix(found.column("v").combine_chunks(), dim), q, _matrix(queries.column("v").combine_chunks(), dim), k, visited[:, leaf])
        return pa.table([pa.array(q[at]), pa.array(ids[row]), pa.array(d)], schema=schema)

    keys = ["g", "qb", "rb"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
