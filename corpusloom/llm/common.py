"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.lineage import cut, ensure_checkpoint_dir

__all__ = ["cut", "ensure_checkpoint_dir"]

#: ASCII white space: the characters \x20 and \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def let(value: Column, body) -> Column:
    """body(value) with value computed once, even where body uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the maximal runs of characters that aren't ASCII white space; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS, -1))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def byte_groups(sizes: list[int], limit: int) -> Iterator[range]:
    """Consecutive ranges of rows of at most limit bytes, or of one row."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield range(start, i)
            start, total = i, 0
        total += n
    if sizes:
        yield range(start, len(sizes))


def text_groups(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in groups of at most limit bytes of text, or of one row. A batch itself is bounded by spark.sql.execution.arrow.maxBytesPerBatch (64 MB unless set)."""
    sizes = pc.binary_length(batch.column(text)).to_pylist()
    for rows in byte_groups(sizes, limit):
        yield batch.slice(rows.start, len(rows))


def arrow_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (A-Z) words between ASCII white space of all texts, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    real = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), np.diff(before[offsets - offsets[0]])


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read again; unlike after cut() columns can be pruned."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
