"""Scores documents with a gated recurrent language model that is learned from the corpus.

1. Words of all texts are counted (a text's end is a word too), those of training documents apart. A document is held out if the CRC-32 of its id modulo FOLDS is 0.
2. The most frequent words, the end and one word for all others are the model's words; how many grows with the cube root of the training words (grown()). Its output begins as their relative frequencies. In each
   of ROUNDS rounds every task trains a copy by truncated backpropagation on the training documents that a hash of their id puts in the round, so that each
   is learned from once, and the copies are averaged, weighted by their words; sums are formed in two steps, so that no task gets all copies.
3. Every text is scored as a whole. A word outside the model's has the probability of "other" times its smoothed share of the other words' counts,
   (c + 0.1) / (M + 0.1 (U + 1)) with M the count of all other words and U of how many, so that the probabilities of all texts add up to one.

The counts of the HOT most frequent words are sent to all tasks, which is bounded; rarer words, of which none can have more than 1 / HOT of all, meet their counts in a join by word.

Null texts are empty: they have the end only. A null id counts as the empty text and hence as held out. Repeated rows count and score each.
Other columns are ignored. Without training documents every count is 0 and the base is uniform over what it knows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import gru
from corpusloom.llm.common import arrow_words, cut, text_groups

FOLDS, HOT, ROUNDS, RATE, ALPHA = 10, 1 << 19, 2, 0.05, 0.1
#: Words of the model: FACTOR times the cube root of the training words, as a power of two within these bounds.
FACTOR, FEWEST, MOST = 13, 256, 4096
#: The end of a text among the words, which hold no white space.
END = "\n"
FLUSH, TOKENS, CHUNK, GROUP_BYTES = 1_500_000, 2_000_000, 8192, 8 << 20


def grown(train_tokens: int) -> int:
    """How many words the model has, but for the end and the word for all others."""
    return max(FEWEST, min(MOST, 1 << round(np.log2(FACTOR * max(train_tokens, 1) ** (1 / 3))))) - 2


def count_words(docs: DataFrame) -> DataFrame:
    """word, c (in training documents), t (in all). docs: _held, _text."""

    def counted(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        flat, _ = arrow_words(texts)
        found = pc.value_counts(flat)
        return pa.concat_arrays([found.field(0), pa.array([END])]), pa.concat_arrays([found.field(1), pa.array([len(texts)], pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0

        def merged() -> pa.Table:
            out = pa.concat_tables(parts).group_by("word").aggregate([("c", "sum"), ("t", "sum")])
            return out.select(["word", "c_sum", "t_sum"]).rename_columns(["word", "c", "t"])

        for batch in batches:
            for rows in text_groups(batch, "_text", GROUP_BYTES):
                for held in (False, True):
                    texts = rows.column("_text").filter(pc.equal(rows.column("_held"), held))
                    if len(texts):
                        word, count = counted(texts)
                        parts.append(pa.table({"word": word, "c": pa.array(np.zeros(len(count), np.int64)) if held else count, "t": count}))
                        n += len(word)
                if n > FLUSH:
                    parts = [merged()]
                    n = len(parts[0])
                    if n > FLUSH // 2:
                        yield from parts[0].to_batches()
                        parts, n = [], 0
        if parts:
            yield from merged().to_batches()

    found = docs.select("_held", "_text").mapInArrow(run, "word string, c long, t long")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def _average(copies: DataFrame) -> DataFrame:
    """copies: part, chunk, weight, values (bytes of float32). The weighted mean of each chunk, first over groups of copies."""

    def add(table: pa.Table) -> pa.Table:
        weight = np.array(table.column("weight").to_pylist())
        values = np.array([np.frombuffer(v, np.float32) for v in table.column("values").to_pylist()])
        mean = (values * (weight / weight.sum())[:, None]).sum(axis=0).astype(np.float32)
        chunk, part = (table.column(c)[0].as_py() for c in ("chunk", "part"))
        return pa.table({"part": pa.array([part % 64], pa.int64()), "chunk": pa.array([chunk], pa.int32()), "weight": pa.array([weight.sum()], pa.float64()), "values": pa.array([mean.tobytes()], pa.binary())})

    schema = "part long, chunk int, weight double, values binary"
    some = copies.withColumn("part", F.pmod("part", F.lit(64))).groupBy("chunk", "part").applyInArrow(add, schema)
    return some.groupBy("chunk").applyInArrow(add, schema)


class Vocabulary:
    """Numbers of the model's words: all others are number 0, alone in their class, then the words by falling frequency from the next class on."""

    def __init__(self, words: list[str], c: np.ndarray, total: int, ends: int):
        """words: the most frequent, without the end, with their counts in training documents."""
        self.other, self.first = 0, gru.class_size(len(words))
        order = np.argsort(-np.array([ends, *c], np.float64), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.counts = np.array([total - ends - c.sum(), *[-1] * (self.first - 1), *np.array([ends, *c], np.float64)[order]])
        self.end = int(rank[0]) + self.first
        self.words, self.numbers = pa.array(words, pa.string()), np.append(rank[1:] + self.first, 0).astype(np.int32)

    def encode(self, flat: pa.Array, n: np.ndarray) -> np.ndarray:
        """The numbers of the words of texts, of which each has n, with an end after each."""
        at = pc.fill_null(pc.index_in(flat, value_set=self.words), len(self.words)).to_numpy()
        return np.insert(self.numbers[at], np.cumsum(n), np.int32(self.end))


def train_round(docs: DataFrame, model, k: int, rounds: int) -> np.ndarray:
    """The averaged weights after one pass over the documents of round k. model: broadcast (vocabulary, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat, like = model.value
        p = gru.unpack(flat, like)
        part, n, weight, mine = None, 0, 0, []

        def learn() -> None:
            nonlocal p, n, weight, mine
            p, weight, n, mine = gru.train(p, mine, vocabulary.end, rate=RATE / (k + 1)), weight + n, 0, []

        for batch in batches:
            for rows in text_groups(batch, "_text", GROUP_BYTES):
                part = rows.column(0)[0].as_py() if part is None else part
                mine.append(vocabulary.encode(*arrow_words(rows.column("_text"))))
                n += len(mine[-1])
                if n > TOKENS:
                    learn()
        learn()
        if weight:
            values = gru.pack(p)
            cuts = [values[i : i + CHUNK].tobytes() for i in range(0, len(values), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int32()), pa.array([float(weight)] * len(cuts)), pa.array(cuts, pa.binary())], ["part", "chunk", "weight", "values"])

    own = docs.filter(~F.col("_held") & (F.pmod(F.xxhash64(F.lit("round"), "_id"), F.lit(rounds)) == k)).select(F.spark_partition_id().cast("long").alias("_part"), "_text")
    rows = _average(own.mapInArrow(run, "part long, chunk int, weight double, values binary")).collect()  # one set of weights
    return np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(rows, key=lambda r: r.chunk)]) if rows else model.value[1]


@dataclass
class Model:
    """What is learned from the corpus: counts of all words, sums of them, and the network's words and weights."""

    counts: DataFrame
    total: int
    distinct: int
    ends: int
    hot: pa.Table
    vocabulary: Vocabulary
    flat: np.ndarray
    like: gru.Params


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_row_id"), key.alias("_id"), (F.crc32(key.cast("binary")) % FOLDS == 0).alias("_held"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_size: int | None = None, rounds: int = ROUNDS, hot: int = HOT) -> Model:
    """Counts of all words, and a network that has gone through every training document once."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    counts = cut(count_words(rows))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0))).first()
    frequent_ones = cut(counts.filter(F.col("word") != END).orderBy(F.desc("t"), "word").limit(hot)).select("word", "c").toArrow()  # at most `hot` words
    known = frequent_ones.filter(pc.greater(frequent_ones["c"], 0)).sort_by([("c", "descending"), ("word", "ascending")]).slice(0, vocabulary_size or grown(total))
    vocabulary = Vocabulary(known["word"].to_pylist(), known["c"].to_numpy().astype(np.float64), total, ends)
    like = gru.init(vocabulary.counts, size=vocabulary.first)
    flat = gru.pack(like)
    for k in range(rounds):
        flat = train_round(rows, spark.sparkContext.broadcast((vocabulary, flat, like)), k, rounds)
    return Model(counts, total, distinct, ends, frequent_ones, vocabulary, flat, like)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learned: Model | None = None, **how) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the model's probability of the text). The model is learned from docs, if none is given."""
    spark = docs.sparkSession
    learned = learned or learn(docs, id_col, text_col, **how)
    counts, total, distinct, ends, vocabulary = learned.counts, learned.total, learned.distinct, learned.ends, learned.vocabulary
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = _rows(docs, id_col, text_col)
    model = spark.sparkContext.broadcast((vocabulary, learned.flat, learned.like, learned.hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat, like, counts = model.value
        p = gru.unpack(flat, like)
        # by place among the hot words; the last place is that of all rarer words
        words = counts.column("word").combine_chunks().cast(pa.string())
        c = np.append(counts.column("c").to_numpy(), 0).astype(np.float64)
        logs, seen = np.log10(c + ALPHA), c > 0
        logs[-1] = 0
        number = np.append(vocabulary.encode(words, np.empty(0, np.int64)), np.int32(vocabulary.other))
        other = number == vocabulary.other
        other_logs = logs * other
        end_log, end_known = np.log10(ends + ALPHA), int(ends > 0)
        rows_of, coded, size = [], [], 0
        names = ["_row_id", "held_out", "n_tokens", "n_known", "base", "n_other", "other", "rare", "model"]

        def done() -> Iterator[pa.RecordBatch]:
            ll = gru.log_likelihoods(p, [d for docs in coded for d in docs], vocabulary.end) / np.log(10)
            start = 0
            for columns in rows_of:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ll[start : start + len(columns[0])], pa.float64())], names)
                start += len(columns[0])
            rows_of.clear()
            coded.clear()

        for batch in batches:
            for rows in text_groups(batch, "_text", GROUP_BYTES):
                flat, n = arrow_words(rows.column("_text"))
                at = pc.fill_null(pc.index_in(flat, value_set=words), len(words)).to_numpy()
                ends_at = np.cumsum(n)
                sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends_at])])  # noqa: B023, E731
                rare = at == len(words)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sums(rare))]), pa.int32()), flat.filter(pa.array(rare)))
                rows_of.append([rows.column("_row_id"), rows.column("_held"), pa.array(n + 1, pa.int64()), pa.array(sums(seen[at]) + end_known, pa.int64()), pa.array(sums(logs[at]) + end_log), pa.array(sums(other[at]), pa.int64()), pa.array(sums(other_logs[at])), lists])
                coded.append(np.split(np.insert(number[at], ends_at, np.int32(vocabulary.end)), np.cumsum(n + 1)[:-1]))
                size += len(flat) + len(n)
                if size > TOKENS:
                    yield from done()
                    size = 0
        if coded:
            yield from done()

    schema = f"_row_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, n_other long, other double, rare array<string>, model double"
    scored = cut(rows.select("_row_id", "_held", "_text").mapInArrow(run, schema).withColumn("_uid", F.monotonically_increasing_id()))
    words = scored.filter(F.size("rare") > 0).select("_uid", F.explode("rare").alias("word")).groupBy("_uid", "word").agg(F.count("*").alias("n"))
    log = F.log10(F.coalesce("c", F.lit(0)) + ALPHA)
    rare = words.join(counts.select("word", "c"), "word", "left").groupBy("_uid").agg(F.sum(F.col("n") * log).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    in_model = total - float(vocabulary.counts[vocabulary.other])
    mass = float(np.log10(total - in_model + ALPHA * (distinct - len(vocabulary.words) - (ends > 0) + 1)))
    base = float(np.log10(total + ALPHA * (distinct + 1)))
    more = F.coalesce("rare_log", F.lit(0.0))
    out = scored.drop("rare").join(rare, "_uid", "left")
    return out.select(
        F.col("_row_id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * base).alias("base_score"), (F.col("model") + F.col("other") + more - F.col("n_other") * mass).alias("score"))


def crc_held(doc_id: object) -> bool:
    """Whether a document is held out, as score() has it."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0
