"""MinHash signatures and LSH bands."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.config import MinHash
from corpusloom.functions import text as tx

PRIME = np.uint64((1 << 61) - 1)
_WORDS = re.compile(r"\w+").findall
_BLOCK = 4096


def hash32(data: bytes) -> int:
    """BLAKE2b of four bytes, as a big-endian number."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=4).digest(), "big")


def coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    a = [hash32(f"{seed}:a:{i}".encode()) | 1 for i in range(n)]
    b = [hash32(f"{seed}:b:{i}".encode()) for i in range(n)]
    return np.array(a, np.uint64), np.array(b, np.uint64)


def shingles(text: str, ngram: int) -> np.ndarray:
    """Distinct hashes of the lower-cased shingles; of fewer words, of all of them."""
    w = _WORDS((text or "").lower())
    grams = {" ".join(g) for g in zip(*[w[i:] for i in range(ngram)], strict=False)} or ({" ".join(w)} if w else set())
    digests = b"".join([hashlib.blake2b(g.encode(), digest_size=4).digest() for g in grams])
    return np.unique(np.frombuffer(digests, ">u4")).astype(np.uint64)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """min over s of (a s + b) mod 2^61 - 1; a s + b stays below 2^64. Blocks bound what a long text takes."""
    if not len(s):
        return None
    return np.min([_mod(a[:, None] * s[k : k + _BLOCK] + b[:, None]).min(axis=1) for k in range(0, len(s), _BLOCK)], axis=0)


def _mod(x: np.ndarray) -> np.ndarray:
    """x mod 2^61 - 1 without a division: 2^61 counts as 1, and what is below the prime wraps to a large number where it is taken off."""
    high = x >> np.uint64(61)
    x &= PRIME
    x += high
    return np.minimum(x, np.subtract(x, PRIME, out=high), out=x)


def keys(text: Column, cfg: MinHash, seed: int) -> Column:
    """array<struct<hi long, lo long>>, empty for a text without words: 128-bit digests, first of the whole signature, then of each band's minima with its number."""
    a, b = coefficients(cfg.num_hashes, seed)

    def of(rows: list[str | None]) -> pa.Array:
        out, ends = [], [0]
        for t in rows:
            sig = signature(shingles(t, cfg.ngram), a, b)
            if sig is not None:
                parts = [sig, *[sig[k * cfg.rows : (k + 1) * cfg.rows] for k in range(cfg.bands)]]
                out += [hashlib.blake2b(x.tobytes(), digest_size=16, salt=k.to_bytes(4, "big")).digest() for k, x in enumerate(parts)]
            ends.append(len(out))
        pairs = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["hi", "lo"]))

    def over(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tx.grouped(texts, of)

    return F.arrow_udf(over, "array<struct<hi:long,lo:long>>")(text)
