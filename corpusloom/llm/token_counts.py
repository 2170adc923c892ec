"""Token counts: lengths of encodings, without the encodings.

Each Arrow batch is regrouped into groups of about equal bytes. A text is cut
before every space that follows a character other than white space. The byte-level
pre-tokenizer always ends a pre-token there, so that the counts of the pieces add up
to the count of the whole text, however long it is. Pieces recur, so that the
lengths seen so far are kept in a dictionary of bounded size, and only pieces not
seen before are encoded, a batch at a time.

Null texts count as empty: 0 bytes, 0 tokens. Repeated rows are counted each. Columns
of the input other than the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import byte_groups

GROUP_BYTES = 1 << 20
#: Kept are pieces of at most CACHE_CHARS characters, CACHE_ENTRIES at most: some 100 MB whatever the texts.
CACHE_ENTRIES, CACHE_CHARS = 600_000, 64
_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def safe_pieces(text: str) -> list[str]:
    """Cuts before each space that follows a non-space; joined again the pieces give the text."""
    if _UNSAFE.search(text):
        return _CUT.split(text)
    head, *rest = text.split(" ")
    return [head, *[f" {x}" for x in rest]] if head else [f" {x}" for x in rest]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class PieceCounter:
    """Token counts of texts; keeps the lengths of at most CACHE_ENTRIES short pieces."""

    def __init__(self, path: str):
        self.encode = _tokenizer(path).encode_batch_fast
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        known, pieces = self.known, [safe_pieces(x) for x in texts]
        new = list(set().union(*pieces).difference(known))
        long = {}
        for rows in byte_groups([len(p) for p in new], GROUP_BYTES):
            part = new[rows.start : rows.stop]
            for piece, n in zip(part, map(len, self.encode(part, add_special_tokens=False)), strict=True):
                (known if len(piece) <= CACHE_CHARS else long)[piece] = n
        if long:
            return [sum(long[p] if p in long else known[p] for p in ps) for ps in pieces]
        get = known.__getitem__
        return [sum(map(get, ps)) for ps in pieces]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row."""
    schema = docs.select(F.col(id_col)).schema
    id_type = schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer_path)
        for batch in batches:
            for rows in byte_groups(batch.column(2).to_pylist(), GROUP_BYTES):
                part = batch.slice(rows.start, len(rows))
                n = counter.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), text.alias("_text"), F.octet_length(text).cast("long").alias("_bytes")).mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
