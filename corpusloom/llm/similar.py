"""Near-duplicates by SimHash fingerprints and the Jaccard similarity of word shingles: all pairs at or above a threshold, none below it.

Each set of shingles has a fingerprint of 64 bits, as in `simhash`. Fingerprints that differ in DISTANCE bits at most meet by pigeonring filtering: they have EQUAL
equal segments of a ring, as its chains tell. Those pairs are compared as whole sets, and what is similar is linked.

At a similarity of 0.8 fingerprints differ in about 10 bits and often in 13, for which pigeonring has no selective keys left. So that no such pair is lost, nodes that are
not in one component by then are compared further, with candidates from the shingles themselves. All sets are put into one order; two sets of similarity t or more share a shingle
among the first n - ceil(t n) + 1 of each, and where they first do, as many follow in each as they must share, so that pairs that
meet under such a key and pass this bound are all pairs there can be. Shingles that a sample of
the documents has often come last in the order, which keeps common passages out of the keys; the order decides about cost only.

Equal sets are one node, named by a hash of the set. Both kinds of keys are gone through in rounds. In each round every node of a key is compared with one node of the key unless they are in
one component already; this joins large groups without pairs within them. In the first round that is the node that shares its keys with most others, as the original of edited copies does, later
the least by a hash of node, key and round, so that a node whose first leaders were unlike it meets others. When what is left to compare is no more than LEFT times the entries (or after ROUNDS, or when a round leaves over GAIN of it), the nodes of a
key that are still in different components are compared with each other. For pairs that shingles name, a set's hashes also make a parity of about as many bits: two parities
differ in no more bits than the sets in shingles, which drops most pairs that share a passage only. The others are compared as whole sets (of
64-bit hashes), made anew from the texts of those nodes that are in a pair. Nothing is dropped that may be similar.

Fewer words than a shingle has are one shingle. Null texts and texts without words are equal empty sets. Repeated rows are equal sets. Of rows with one id
and different texts each is in the component of its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import arrow_words, cut, stored, text_groups
from corpusloom.llm.simhash import keep_first, majority_bits, ring_keys, text_hash
from corpusloom.operators.graph import components

SHINGLE, SIMILARITY = 5, 0.8
#: Bits that fingerprints may differ in, and segments that make a key: 56 keys of 24 bits.
DISTANCE, EQUAL = 5, 3
#: One of SAMPLE documents tells which shingles are common: those it has in OFTEN documents, COMMON of them at most.
SAMPLE, OFTEN, COMMON = 16, 4, 1 << 16
#: Buckets of nodes that are in a pair; a leader with more than MANY pairs meets them in SALTS tasks.
BUCKETS, MANY, SALTS = 1 << 18, 512, 64
GROUP_BYTES, BITS, MOST_BITS, ROUNDS, LEFT, GAIN = 1 << 20, 512, 1 << 16, 6, 0.25, 0.95
_E = 1e-9
_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """64 bits from 64 bits."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: pa.Array, size: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of shingle hashes of the texts, one after another, each in order with the hashes in last (sorted) behind the others; and how many each has."""
    flat, n = arrow_words(texts)
    coded = flat.dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    word = np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)[coded.indices.to_numpy()]
    ends = np.cumsum(n)
    begins = ends - n
    with np.errstate(over="ignore"):
        many = max(0, len(word) - size + 1)
        own = np.zeros(many, np.uint64)
        for k in range(size):
            own = own * np.uint64(_ODD) + word[k : k + many]
        # a shingle begins at each word with size - 1 more of its text behind it
        row = np.repeat(np.arange(len(n)), n)[:many]
        whole = np.arange(many) + size <= ends[row] if many else np.empty(0, bool)
        own, row = own[whole], row[whole]
        few = np.flatnonzero((n > 0) & (n < size))
        short = np.zeros(len(few), np.uint64)
        for k in range(size - 1):
            on = n[few] > k
            short[on] = short[on] * np.uint64(_ODD) + word[begins[few[on]] + k]
        own, row = _mix(np.concatenate([own, short + np.uint64(1)])).view(np.int64), np.concatenate([row, few])
    late = last[np.minimum(np.searchsorted(last, own), len(last) - 1)] == own if len(last) else np.zeros(len(own), bool)
    order = np.lexsort((own, late, row))
    own, row = own[order], row[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    return own[new], np.bincount(row[new], minlength=len(n))


def _lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values, pa.int64()))


def _names(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever its order."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(values.view(np.uint64)), dtype=np.uint64)])
        ends = np.cumsum(n)
        return _mix(sums[ends] - sums[ends - n] + n.astype(np.uint64)).view(np.int64)


def _parities(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """For each set a power of two of bits, no fewer than its hashes and BITS (and no more than MOST_BITS): whether an odd number of them fall on a bit."""
    words = np.minimum(np.maximum(1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), BITS), MOST_BITS) >> 6
    begins = np.cumsum(words) - words
    out = np.zeros(int(words.sum()), np.int64)
    if len(values):
        bit = values & np.repeat((words << 6) - 1, n)
        at = np.repeat(begins, n) + (bit >> 6)
        order = np.argsort(at, kind="stable")
        at, own = at[order], (np.int64(1) << (bit & 63))[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        out[at[first]] = np.bitwise_xor.reduceat(own, first)
    return _lists(out, words)


def _apart(p: Column, q: Column) -> Column:
    """How many bits two parities differ in; the longer one is folded to the shorter's length."""
    size = F.least(F.size(p), F.size(q))
    word = lambda x, i: F.get(x, i).bitwiseXOR(F.coalesce(F.get(x, i + size), F.lit(0)))
    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda a, i: a + F.bit_count(word(p, i).bitwiseXOR(word(q, i))))


def _text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text_hash(text_col).alias("text_hash"), text.alias("_text"))


def _common(texts: DataFrame, size: int) -> np.ndarray:
    """Hashes of the shingles that the sample has often, COMMON at most, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_groups(batch, "_text", GROUP_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(rows.column("_text"), size, np.empty(0, np.int64))[0])], ["h"])

    sample = texts.filter(F.pmod(F.xxhash64("_id"), F.lit(SAMPLE)) == 0).select("_text").mapInArrow(run, "h long")
    often = sample.groupBy("h").count().filter(F.col("count") >= OFTEN).orderBy(F.desc("count"), "h").limit(COMMON).collect()  # at most COMMON
    return np.sort(np.array([r.h for r in often], np.int64))


def _prefixes(texts: DataFrame, size: int, similarity: float, last) -> DataFrame:
    """_id, text_hash, node (the set's hash), n, fp (the fingerprint), keys (the first of the set), bits (the parity)."""
    id_type = texts.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_groups(batch, "_text", GROUP_BYTES):
                values, n = shingle_sets(rows.column("_text"), size, last.value)
                first = np.where(n > 0, n - np.ceil(n * similarity - _E).astype(np.int64) + 1, 0)
                ends = np.cumsum(n)
                keep = np.arange(len(values)) < np.repeat(ends - n + first, n)
                own = [pa.array(_names(values, n)), pa.array(n, pa.int32()), pa.array(majority_bits(values, np.concatenate([[0], ends])), pa.int64()), _lists(values[keep], first), _parities(values, n)]
                yield pa.RecordBatch.from_arrays([rows.column("_id"), rows.column("text_hash"), *own], ["_id", "text_hash", "node", "n", "fp", "keys", "bits"])

    return texts.mapInArrow(run, f"_id {id_type}, text_hash long, node long, n int, fp long, keys array<bigint>, bits array<bigint>")


def _bucket(*c: str) -> Column:
    return F.pmod(F.xxhash64(*c), F.lit(BUCKETS)).cast("int")


def _sets(texts: DataFrame, rows: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """node, hs of the nodes in pairs (a, b), each from the text of one row. Texts of other rows are left out before they are moved, by the hash of their row."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = cut(rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("_id", "text_hash")).alias("_r")).select("_r._id", "_r.text_hash"))
    some = F.broadcast(one.select(_bucket("_id", "text_hash").alias("_k")).distinct())  # BUCKETS at most
    wanted = texts.withColumn("_k", _bucket("_id", "text_hash")).join(some, "_k", "left_semi").join(one, ["_id", "text_hash"], "left_semi").dropDuplicates(["_id", "text_hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_groups(batch, "_text", GROUP_BYTES):
                values, n = shingle_sets(part.column("_text"), size, np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(_names(values, n)), _lists(values, n)], ["node", "hs"])

    return stored(wanted.select("_text").mapInArrow(run, "node long, hs array<bigint>"))


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs (a, b) whose sets have the similarity. A b with more than MANY pairs meets them in SALTS tasks."""
    hot = pairs.groupBy("b").count().filter(F.col("count") > MANY).select("b", F.lit(SALTS).alias("_s"))
    salted = pairs.join(hot, "b", "left").withColumn("_s", F.pmod(F.xxhash64("a"), F.coalesce("_s", F.lit(1))).cast("int"))
    right = salted.select("b", "_s").distinct().join(sets.select(F.col("node").alias("b"), F.col("hs").alias("hb")), "b")
    both = salted.join(sets.select(F.col("node").alias("a"), F.col("hs").alias("ha")), "a").join(right, ["b", "_s"])
    common = F.size(F.array_intersect("ha", "hb"))
    return stored(both.filter(common / (F.size("ha") + F.size("hb") - common) >= similarity).select("a", "b"))


def _shared(entries: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """key, node, cols of the keys that several nodes have, with _d (how many entries the keys of the node have)."""
    entries = entries.repartition("key")  # moved once for both uses
    # _x keeps both uses of entries alike, so that they are moved once
    twice = entries.groupBy("key").agg(F.count("*").alias("_m"), F.max(F.struct("node", *cols)).alias("_x")).filter("_m > 1 AND _x IS NOT NULL").select("key", "_m")
    shared = stored(entries.join(twice, "key"))
    hubs = cut(shared.groupBy("node").agg(F.sum("_m").alias("_d")))
    return stored(shared.join(hubs, "node").select("key", "node", *cols, "_d"))


def _rounds(shared: DataFrame, cols: tuple[str, ...], may: Callable, similar_ones: Callable, found: DataFrame | None = None) -> DataFrame:
    """found and further pairs a, b, which connect all nodes that meet under a key, may be similar by cols (may takes two functions from a name to a side's column) and are."""
    leader = lambda last, *by: last(F.struct("node", *cols), F.struct(*by, "node")).alias("_l")
    label_of = lambda rows: rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labels = None if found is None else cut(components(found)).select("node", "label")
    at, before = shared, float("inf")
    for k in range(ROUNDS):
        lead = at.join(at.groupBy("key").agg(leader(F.min_by, F.xxhash64("key", "node", F.lit(k))) if k else leader(F.max_by, "_d")), "key")
        lead = lead.filter((F.col("node") != F.col("_l.node")) & may(F.col, lambda c: F.col(f"_l.{c}")))
        if labels is not None:  # those in one component already are left out
            of = labels.select(F.col("node").alias("_n"), F.col("label").alias("_label"))
            lead = (lead if k else label_of(lead)).join(of, F.col("_l.node") == F.col("_n"), "left").filter(F.col("label") != F.coalesce("_label", "_l.node"))
        more = similar_ones(lead.select(F.col("node").alias("a"), F.col("_l.node").alias("b")))
        found = more if found is None else found.unionByName(more)
        labels = cut(components(found)).select("node", "label")
        at = label_of(shared)
        by = at.groupBy("key", "label").agg(F.count("*").alias("m")).groupBy("key").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"), F.count("*").alias("labels"))
        mixed = cut(by.filter("labels > 1"))
        at = stored(at.join(mixed.select("key"), "key", "left_semi"))
        left, size_of = mixed.agg(F.coalesce(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
        if left <= LEFT * size_of or left > GAIN * before:
            break
        shared, before = at.drop("label"), left
    other = at.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", *cols, "label")])
    rest = at.join(other, "key").filter((F.col("label") < F.col("label2")) & may(F.col, lambda c: F.col(f"{c}2")))
    return found.unionByName(similar_ones(rest.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))))


def near_links(texts: DataFrame, rows: DataFrame, size: int, similarity: float, distance: int) -> DataFrame:
    """Pairs a, b of nodes that connect all sets of the similarity whose fingerprints differ in no more bits than the distance."""

    def similar_ones(pairs: DataFrame) -> DataFrame:
        few = cut(pairs.distinct())
        return few if few.isEmpty() else _alike(few, _sets(texts, rows, few, size), similarity)

    nodes = rows.filter("n > 0").select("node", "fp").distinct()
    shared = _shared(nodes.select("node", "fp", F.explode(ring_keys(F.col("fp"), distance, EQUAL)).alias("key")), ("fp",))
    return _rounds(shared, ("fp",), lambda a, b: F.bit_count(a("fp").bitwiseXOR(b("fp"))) <= distance, similar_ones)


def links(texts: DataFrame, rows: DataFrame, size: int, similarity: float, found: DataFrame | None = None) -> DataFrame:
    """rows: _id, text_hash, node, n, keys, bits. Pairs a, b of nodes that connect all sets of the similarity: each such pair, or a path of such pairs between its ends; found are some of them."""
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min(F.struct("_id", "text_hash")).alias("_r")).select("node", "_r._id", "_r.text_hash")
    firsts = rows.join(nodes, ["node", "_id", "text_hash"], "left_semi").select("node", "n", F.posexplode("keys").alias("pos", "key"))
    shared = _shared(firsts, ("n", "pos"))
    parity = stored(rows.join(shared.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("p")))

    def may_fit(a: Callable, b: Callable) -> Column:
        """The sizes allow it, and behind the key (places pos) there is as much as they must share."""
        n, m = a("n"), b("n")
        most = F.least(n - a("pos"), m - b("pos"))
        return (F.least(n, m) >= F.greatest(n, m) * similarity - _E) & (most >= (n + m) * (similarity / (1 + similarity)) - _E)

    def similar_ones(pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, b) that are similar."""
        side = lambda c: parity.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("p").alias(f"p{c}"))
        both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        fits = F.greatest(F.size("pa"), F.size("pb")) <= 2 * F.least(F.size("pa"), F.size("pb"))  # as sizes of similar sets are
        few = cut(both.filter(fits & (_apart(F.col("pa"), F.col("pb")) <= (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + _E)).select("a", "b"))
        return few if few.isEmpty() else _alike(few, _sets(texts, rows, few, size), similarity)

    return _rounds(shared, ("n", "pos"), may_fit, similar_ones, found)


def _classes(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: float, distance: int) -> DataFrame:
    """_id, text_hash (hash of the text) and _first (the least of both in its component) of the rows with an id."""
    texts = _text(docs.filter(F.col(id_col).isNotNull()), id_col, text_col)
    last = docs.sparkSession.sparkContext.broadcast(_common(texts, size))
    rows = stored(_prefixes(texts, size, similarity, last))
    near = near_links(texts, rows, size, similarity, distance)
    labels = components(links(texts, rows, size, similarity, near)).select("node", "label")
    nodes = rows.groupBy("node").agg(F.min(F.struct("_id", "text_hash")).alias("_r")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = nodes.groupBy("label").agg(F.min("_r").alias("_first"))
    return rows.select("_id", "text_hash", "node").join(nodes.join(least, "label").select("node", "_first"), "node").select("_id", "text_hash", "_first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, distance: int = DISTANCE) -> DataFrame:
    """id, component_id (the smallest id reachable over pairs of the similarity) of the rows with an id."""
    return _classes(docs, id_col, text_col, size, similarity, distance).select(F.col("_id").alias(id_col), F.col("_first._id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, distance: int = DISTANCE) -> DataFrame:
    """The row of docs with the smallest id of each component, of repeated rows one. Rows with a null id stay. Where one id has several texts, each is judged on its own."""
    return keep_first(docs, _classes(docs, id_col, text_col, size, similarity, distance), id_col, text_col)
