"""Text primitives as Column expressions: words, lines, white space, normalisation, ids and hosts."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: letters, numbers of any kind and the underscore.
WORD = r"[\p{L}\p{N}_]+"
#: A sign that makes a word alphabetic; non-decimal numerals count.
ALPHA = r"[\p{L}\p{Nl}\p{No}]"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
#: Zero-width signs, the byte order mark and the soft hyphen.
ZERO_WIDTH = "​‌‍﻿­"
CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: Below U+0300 nothing combines and nothing has another composed form.
MAY_COMPOSE = r"[^\x{0}-\x{2ff}]"
#: Bytes of text that a Python worker holds as strings at a time.
GROUP_BYTES = 1 << 20


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends; trim() would keep tabs and line feeds."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def raw_lines(text: Column) -> Column:
    return F.split(text, r"\R", -1)


def lines(text: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(raw_lines(text), strip), lambda x: x != "")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"(?U)\n\s*\n", -1), strip), lambda x: x != "")


def total_length(parts: Column) -> Column:
    return F.length(F.array_join(parts, ""))


def grouped(texts: Iterator[pa.Array], f: Callable[[list[str | None]], pa.Array]) -> Iterator[pa.Array]:
    """f over all rows, in groups of about GROUP_BYTES or of one row: an Arrow batch of ten thousand rows never stands as Python strings at once."""
    for part in texts:
        start = total = 0
        for i, n in enumerate(pc.binary_length(part).to_pylist()):
            if i > start and total + (n or 0) > GROUP_BYTES:
                yield f(part.slice(start, i - start).to_pylist())
                start, total = i, 0
            total += n or 0
        yield f(part.slice(start).to_pylist())


def _nfc(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return grouped(texts, lambda rows: pa.array([x and unicodedata.normalize("NFC", x) for x in rows], pa.string()))


def nfc(text: Column) -> Column:
    """Only texts that may change go to Python."""
    other = F.when(F.rlike(text, F.lit(MAY_COMPOSE)), text)
    return F.coalesce(F.arrow_udf(_nfc, "string")(other), text)


def normalize(text: Column) -> Column:
    """NFC, then without zero-width signs and controls, blanks and tabs as one blank, at most one empty line in a row, stripped."""
    out = F.regexp_replace(F.translate(nfc(text), ZERO_WIDTH, ""), CONTROLS, "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return strip(out)


def stable_id(*parts: Column) -> Column:
    """The first 16 hex digits of SHA-256 over the parts, each followed by U+001F."""
    ended = [x for p in parts for x in (p, F.lit("\x1f"))]
    return F.substring(F.sha2(F.concat(*ended), 256), 1, 16)


def url_host(url: Column) -> Column:
    """Authority with port and user info; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value) with value computed once, even where body uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
