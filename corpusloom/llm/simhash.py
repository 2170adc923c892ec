"""SimHash near-duplicates, with candidates from pigeonring filtering.

The 64 bits of a fingerprint are a ring of four segments of 16. Two fingerprints that differ in at most
2 bits have a segment from which every chain of l consecutive segments differs in at most l * 2/4 bits: 0 in
one, 1 in two or three, 2 in all. Of the second and third segment of such a chain one is thus equal as
well, so that the pair meets under a key of two equal segments (six keys for a fingerprint). Pairs of a key are pruned by the
chain's budgets before the full Hamming check.

Equal fingerprints are one node. A key with more than PAIRS nodes isn't joined with itself: each of its nodes is
listed under itself and under each flip of one of the 32 bits outside the key; two nodes within 2 bits share an
entry and all nodes of an entry (33 at most) are within 2 bits of each other, so a star links them. Nothing is dropped.

Null texts have no words: fingerprint zero, linked like any other. Repeated rows share a fingerprint and hence a component.
Rows with a null id get a fingerprint but belong to no component (null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, let, lower_ascii, words_of
from corpusloom.operators.graph import components

SHINGLE, DISTANCE, PAIRS = 3, 2, 32
_BLOCK = 1 << 18
#: The two segments of each key, and from which of them a chain may start.
KEYS = (((0, 1), (0,)), ((1, 2), (1,)), ((2, 3), (2,)), ((3, 0), (3,)), ((0, 2), (0, 2)), ((1, 3), (1, 3)))


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 with seed 42 of every shingle of the lower-cased words, in order, repeats included; of fewer words, of all of them."""

    def hashes(w: Column) -> Column:
        n = F.size(w)
        of = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))
        some = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
        return F.when(n < size, some).otherwise(F.transform(F.sequence(F.lit(0), n - size), of))

    return let(words_of(lower_ascii(text)), hashes)


def majority_bits(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each slice of values the 64 bits that are set in over half of it; zero for an empty one."""
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    row = 0
    while row < len(out):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK, side="right")) - 1)
        sums = np.zeros((end - row, 64), dtype=np.int64)
        filled = np.flatnonzero(np.diff(offsets[row : end + 1]))
        for start in range(int(offsets[row]), int(offsets[end]), _BLOCK):  # more than one block only for a single long slice
            part = values[start : min(start + _BLOCK, int(offsets[end]))]
            bits = np.unpackbits(part.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = np.maximum(offsets[row : end][filled] - start, 0)
            sums[filled] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        n = np.diff(offsets[row : end + 1])[:, None]
        out[row:end] = ((2 * sums > n) * powers).sum(axis=1, dtype=np.uint64)
        row = end
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp (the 64 bits as a long), text_hash."""
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            fp = majority_bits(lists.values.to_numpy(zero_copy_only=False), offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), batch.column(2)], [id_col, "fp", "text_hash"])

    hashed = docs.select(F.col(id_col), shingle_hashes(F.col(text_col)).alias("_h"), text_hash(text_col).alias("text_hash"))
    return hashed.mapInArrow(run, f"`{id_col}` {id_type}, fp long, text_hash long")


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))


def _keys(fp: Column) -> Column:
    """kind, key: two segments side by side."""
    return F.array(*[F.struct(F.lit(k).alias("kind"), F.shiftleft(_segment(fp, i), 16).bitwiseOR(_segment(fp, j)).alias("key")) for k, ((i, j), _) in enumerate(KEYS)])


def _within_budgets(x: Column, kind: Column) -> Column:
    """x: differing bits. Whether a chain that starts where the key allows keeps its budgets at lengths 2 and 3, then whether all of x has 2 bits at most."""
    d = [F.bit_count(_segment(x, i)) for i in range(4)]
    chain = F.lit(False)
    for k, (_, starts) in enumerate(KEYS):
        ok = F.lit(False)
        for i in starts:
            ok = ok | ((d[i] == 0) & (d[i] + d[(i + 1) % 4] + d[(i + 2) % 4] <= 1))
        chain = chain | ((kind == k) & ok)
    return chain & (F.bit_count(x) <= DISTANCE)


def ring_masks(distance: int, equal: int) -> list[int]:
    """Masks of the bits of each key by which fingerprints within a distance meet: equal segments of a ring of distance + equal.

    From some segment every chain of l segments differs in at most l * distance / segments bits, so that this segment is equal, and of the l - 1 behind it as many as that
    budget can't reach. A key is such a segment with the first equal - 1 places where the next equal ones can be. Each two fingerprints within the distance have a key in common.
    """
    m = distance + equal
    ends = [64 * i // m for i in range(m + 1)]
    segment = [(1 << ends[i + 1]) - (1 << ends[i]) for i in range(m)]
    reach = [next(n - 1 for n in range(1, m + 1) if n - 1 - n * distance // m >= k) for k in range(1, equal)]
    behind = [c for c in combinations(range(1, m), equal - 1) if all(at <= r for at, r in zip(c, reach, strict=True))]
    return sorted({segment[i] | sum(segment[(i + at) % m] for at in c) for i in range(m) for c in behind})


def ring_keys(fp: Column, distance: int, equal: int) -> Column:
    """The keys of a fingerprint, as hashes of its bits under each mask; others with the same hash are told apart by their distance."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in ring_masks(distance, equal)])
    return F.transform(masks, lambda m: F.xxhash64(fp.bitwiseAND(m), m))


def links(nodes: DataFrame) -> DataFrame:
    """nodes: id, fp, all fp distinct. Pairs a, b of ids that connect all fingerprints within 2 bits: each such pair, or a path between its ends."""
    rows = cut(nodes.select("id", "fp", F.explode(_keys(F.col("fp"))).alias("k")).select("id", "fp", "k.kind", "k.key"))
    sizes = rows.groupBy("kind", "key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = cut(rows.join(sizes, ["kind", "key"]))
    few = rows.filter(F.col("n") <= PAIRS).select("kind", "key", "id", "fp")
    other = few.select(F.col("kind").alias("kind2"), F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("fp").alias("fp2"))
    x = F.col("fp").bitwiseXOR(F.col("fp2"))
    pairs = few.join(other, (F.col("kind") == F.col("kind2")) & (F.col("key") == F.col("key2")) & (F.col("id") < F.col("id2")) & _within_budgets(x, F.col("kind"))).select(F.col("id").alias("a"), F.col("id2").alias("b"))
    flips = F.lit(None)
    for k, ((i, j), _) in enumerate(KEYS):
        free = [b for s in range(4) if s not in (i, j) for b in range(16 * s, 16 * s + 16)]
        masks = F.array(*[F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("long") for m in [0, *[1 << b for b in free]]])
        flips = F.when(F.col("kind") == k, masks).otherwise(flips)
    many = rows.filter(F.col("n") > PAIRS).select("id", "fp", "kind", F.explode(flips).alias("m"))
    entries = many.groupBy("kind", F.col("fp").bitwiseXOR(F.col("m")).alias("at")).agg(F.collect_set("id").alias("ids")).filter(F.size("ids") > 1)
    stars = entries.select(F.array_min("ids").alias("a"), F.explode("ids").alias("b")).filter("a <> b")
    return pairs.unionByName(stars)


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, fp, text_hash and _first (the least id and text in the component; null without an id)."""
    fps = cut(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "_id"))
    nodes = cut(fps.filter("_id is not null").groupBy("fp").agg(F.min(F.struct("_id", "text_hash")).alias("_r")).withColumn("id", F.col("fp")))
    labels = components(links(nodes))
    known = nodes.join(labels, nodes.id == labels.node, "left").select("fp", "_r", F.coalesce("label", "id").alias("label"))
    least = known.groupBy("label").agg(F.min("_r").alias("_first"))
    out = fps.join(known.join(least, "label").select("fp", "_first"), "fp", "left")
    return out.withColumn("_first", F.when(F.col("_id").isNotNull(), F.col("_first")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (the smallest id reachable over links of 2 bits at most)."""
    return _classes(docs, id_col, text_col).select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("_first._id").alias("component_id"))


def keep_first(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of each component in found (_id, text_hash, _first) the row of docs that is first, of repeated rows one, and the rows with a null id."""
    first = cut(found.filter(F.struct("_id", "text_hash") == F.col("_first")).select("_id", "text_hash").distinct())
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), text_hash(text_col).alias("text_hash"))
    kept = rows.join(first, ["_id", "text_hash"]).groupBy("_id", "text_hash").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return kept.select("_row.*").unionByName(docs.filter(F.col(id_col).isNull()))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of docs with the smallest id of each component, of repeated rows one. Rows with a null id stay. Where one id has several texts, each is judged on its own."""
    return keep_first(docs, _classes(docs.select(id_col, text_col), id_col, text_col), id_col, text_col)
