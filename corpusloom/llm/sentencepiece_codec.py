"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The agenda of a unit holds every pair of neighbours that make a piece, best score first, leftmost first among equals. A pair
that is taken from it is merged, or skipped if a keyed hash of (seed, document's id, place, unit, number of the candidate) is below the dropout rate, so that every
occurrence of a unit is drawn anew; a skipped pair comes back only with new neighbours. Without dropout the pieces are those of the library.

No piece joins a character to a space behind it (checked when the model is loaded), so that units, words with the spaces
before them, are independent (runs of letters and of other signs, where no piece joins these either) and texts of any length need no more than the unit at hand. What is skipped
is a mask with a bit for each candidate, and a unit's pieces follow from it and the mask: units that recur with an equal mask are looked up, the others encoded. The character
U+2581, which the library takes for a space, and characters without a piece are written as bytes: decoding always gives the text back.

Null texts are empty and have no pieces. Repeated rows are encoded alike, as the hash depends on id and text only.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import byte_groups

DROPOUT, SEED, CACHE_ENTRIES, STORE_IDS = 0.1, 42, 600_000, 1 << 23
#: Drawings of a unit that the tests hold against each other.
VARIANTS = 4
GROUP_BYTES = 1 << 20
#: Texts longer than this are cut into blocks of as many units.
BLOCK = 1 << 16
#: Units up to _MASKED characters have 3 * (_MASKED - 1) < 64 candidates at most: those at first, and two with each merge.
_NONE, _SHORT, _MASKED, _SPREAD = 1 << 30, 48, 22, 0x9E3779B97F4A7C15
_WORD_UNIT = re.compile(r" *[^ \n]+|\n| +")
_LETTER, _OTHER = r"[^\W\d_²³¹¼½¾]", r"(?:[^\w \n]|[\d_²³¹¼½¾])"
_SCRIPT_UNIT = re.compile(f" *{_LETTER}+| *{_OTHER}+|\n| +")
_MIXED = re.compile(f"{_LETTER}{_OTHER}|{_OTHER}{_LETTER}")


def _hash(base: int, step: int, rank: int) -> int:
    """32 bits from the hash of seed, variant and unit, the number of the candidate and its piece."""
    x = (base ^ rank * 0x9E3779B1 ^ step * 0x85EBCA77) & 0xFFFFFFFF
    return (x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF


def _hash_many(base: np.ndarray, step: int, rank: np.ndarray) -> np.ndarray:
    x = base ^ rank.astype(np.uint32) * np.uint32(0x9E3779B1) ^ np.uint32(step * 0x85EBCA77 & 0xFFFFFFFF)
    return (x ^ x >> np.uint32(15)) * np.uint32(0x2C1B3C6D)


def _mix(x: np.ndarray) -> np.ndarray:
    """64 bits from 64 bits."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Codec:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.seed, self.limit = seed, int(dropout * (1 << 32))
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = [0] * 256
        ranked: dict[str, tuple[float, int]] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                text = piece.replace("▁", " ")
                self.bytes_of[i] = text.encode()
                ranked[text] = (-sp.get_score(i), i)
        if any("\n" in x or " " in x.lstrip(" ") for x in ranked):
            raise ValueError("a piece spans a line feed, or a space that follows another character")
        # where no piece joins a letter to another sign, as in models trained by script, words without their punctuation are units
        self.unit = _WORD_UNIT if any(map(_MIXED.search, ranked)) else _SCRIPT_UNIT
        self.units = self.unit.findall
        order = {score: r for r, score in enumerate(sorted({score for score, _ in ranked.values()}))}
        self.ranks, self.ids = {x: order[score] for x, (score, _) in ranked.items()}, {x: i for x, (_, i) in ranked.items()}
        self._tables()
        lengths = np.array([len(b) for b in self.bytes_of])
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Empties what is looked up: units by number, their hashes and lengths, and pieces by number and mask."""
        self.number: dict[str, int] = {}
        self.unit_hash, self.unit_length = np.empty(0, np.uint64), np.empty(0, np.int64)
        #: number of what is stored for a unit without a skip, by the unit's number, and for one with a mask
        self.whole, self.known = np.empty(0, np.int64), {}
        self.store, self.filled = np.empty(1 << 16, np.int32), 0
        self.store_start, self.store_length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _keep(self, encoded: list[bytes]) -> np.ndarray:
        """Stores encodings and gives their numbers."""
        flat, lengths = np.frombuffer(b"".join(encoded), np.int32), np.array([len(x) for x in encoded], np.int64) >> 2
        if self.filled + len(flat) > len(self.store):
            self.store = np.concatenate([self.store[: self.filled], np.empty(self.filled + 2 * len(flat), np.int32)])
        self.store[self.filled : self.filled + len(flat)] = flat
        first = len(self.store_start)
        self.store_start = np.append(self.store_start, self.filled + np.cumsum(lengths) - lengths)
        self.store_length = np.append(self.store_length, lengths)
        self.filled += len(flat)
        return np.arange(first, first + len(encoded))

    def _tables(self) -> None:
        """For the agendas of many units at once: symbols are numbers, and a hash table has the rank of each pair that makes a piece."""
        names = [*self.ids, *sorted({c for x in self.ids for c in x} - self.ids.keys())]
        number = {x: k for k, x in enumerate(names)}
        self.symbols, unknown = len(names), len(names)
        self.of_char = np.full(0x110000, unknown, np.int64)
        for x, k in number.items():
            if len(x) == 1:
                self.of_char[ord(x)] = k
        self.id_of = np.array([self.ids.get(x, -1) for x in names] + [-1], np.int32)
        pairs = {number[x[:i]] * (unknown + 1) + number[x[i:]]: x for x in self.ranks for i in range(1, len(x)) if x[:i] in number and x[i:] in number}
        self.bits = max(4, (2 * len(pairs)).bit_length() + 1)
        self.pair_keys, self.pair_ranks, self.pair_made = (np.full(1 << self.bits, x, np.int64) for x in (-1, _NONE, unknown))
        for key, x in pairs.items():
            at = key * _SPREAD >> 64 - self.bits & (1 << self.bits) - 1
            while self.pair_keys[at] >= 0:
                at = at + 1 & (1 << self.bits) - 1
            self.pair_keys[at], self.pair_ranks[at], self.pair_made[at] = key, self.ranks[x], number[x]

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the hash table has each two symbols; an empty place if they make no piece."""
        key = a * (self.symbols + 1) + b
        at = (key.astype(np.uint64) * np.uint64(_SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):
            there = self.pair_keys[at[todo]]
            todo = todo[(there >= 0) & (there != key[todo])]
            at[todo] = at[todo] + 1 & (1 << self.bits) - 1
        return at

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.pair_ranks[self._slot(a, b)]

    def _many(self, units: list[str], n: np.ndarray, bases: list[int], masks: list[int] | None = None) -> list[bytes | None]:
        """encode_unit of many units of n, up to _SHORT, characters, one candidate of each at a time; None for those with signs that have no number. With masks these say what is skipped."""
        chars = self.of_char[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        width, rows = int(n.max()), np.repeat(np.arange(len(units)), n)
        sym = np.full((len(units), width + 1), self.symbols, np.int64)
        sym[rows, np.arange(len(chars)) - np.repeat(np.cumsum(n) - n, n)] = chars
        ranks = self._rank(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(len(units), width)
        base, limit, step = np.array(bases, np.uint32) if masks is None else np.array(masks, np.uint64), self.limit, 0
        live, columns, done = np.arange(len(units)), np.arange(width), sym.copy()
        while True:
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(live)), best]
            if not (on := rank < _NONE).all():
                done[live[~on]] = sym[~on]
                live, sym, ranks, best, rank, base = live[on], sym[on], ranks[on], best[on], rank[on], base[on]
            if not len(live):
                break
            step += 1
            skip = _hash_many(base, step, rank) < limit if masks is None else (base >> np.uint64(step - 1) & np.uint64(1)).astype(bool)
            ranks[skip, best[skip]] = _NONE
            rows = np.flatnonzero(~skip)
            at = best[rows]
            from_ = columns + (columns > at[:, None])
            part = sym[rows]
            k = np.arange(len(rows))
            made = self.pair_made[self._slot(part[k, at], part[k, at + 1])]
            part[:, :-1] = np.take_along_axis(part, from_, axis=1)
            part[:, -1] = self.symbols
            part[k, at] = made
            near = ranks[rows]
            near = np.take_along_axis(near, np.minimum(from_, width - 1), axis=1)
            near[:, -1] = _NONE
            near[k, at] = self._rank(part[k, at], part[k, at + 1])
            some = at > 0
            near[k[some], at[some] - 1] = self._rank(part[k[some], at[some] - 1], part[k[some], at[some]])
            sym[rows], ranks[rows] = part, near
        ids, lengths = self.id_of[done], (done < self.symbols).sum(axis=1)
        known = (n > 0) & ~((ids < 0) & (np.arange(width + 1) < lengths[:, None])).any(axis=1)
        known &= np.bincount(np.repeat(np.arange(len(units)), n), chars == self.symbols, len(units)) == 0
        return [row[:m].tobytes() if ok else None for row, m, ok in zip(ids, lengths.tolist(), known.tolist(), strict=True)]

    def learn(self, units: set[str], variant: int) -> dict[str, bytes]:
        """Encodings of units in one drawing."""
        some = list(units)
        return dict(zip(some, self._encode_units(some, [self._base(u, variant) for u in some]), strict=True))

    def _encode_units(self, units: list[str], bases: list[int], masks: list[int] | None = None) -> list[bytes]:
        out: list[bytes] = [b""] * len(units)
        sizes = np.array([len(u) for u in units], np.int64)
        short = [k for k in np.argsort(sizes, kind="stable").tolist() if sizes[k] <= _SHORT]
        for start in range(0, len(short), 4096):
            part = short[start : start + 4096]
            found = self._many([units[k] for k in part], sizes[part], [bases[k] for k in part] if masks is None else [], masks and [masks[k] for k in part])
            for k, got in zip(part, found, strict=True):
                out[k] = self._ids(units[k], *((bases[k], None) if masks is None else (0, masks[k]))) if got is None else got
        for k in np.flatnonzero(sizes > _SHORT).tolist():
            out[k] = self._ids(units[k], bases[k])
        return out

    def _base(self, unit: str, variant: int) -> int:
        return xxhash.xxh32_intdigest(unit, seed=self.seed * VARIANTS + variant & 0xFFFFFFFF) if self.limit else 0

    def encode_unit(self, unit: str, variant: int) -> bytes:
        """The ids as int32s."""
        return self._ids(unit, self._base(unit, variant))

    def _ids(self, unit: str, base: int, mask: int | None = None) -> bytes:
        symbols, _ = self._long(unit, base) if len(unit) > _SHORT else self._short(unit, base, mask)
        ids = array("i")
        get = self.ids.get
        for s in symbols:
            if (i := get(s)) is not None:
                ids.append(i)
            else:
                ids.extend([self.byte_ids[b] for b in s.encode()])
        return ids.tobytes()

    def _short(self, unit: str, base: int, mask: int | None = None) -> tuple[list[str], int]:
        """The agenda is a list with the rank of each pair; min and index find the best, the leftmost of equals."""
        get, skips, limit, skipped, step = self.ranks.get, _hash, self.limit, 0, 0
        sym = list(unit)
        agenda = [get(a + b, _NONE) for a, b in pairwise(sym)]
        while agenda and (best := min(agenda)) != _NONE:
            i = agenda.index(best)
            step += 1
            if mask >> step - 1 & 1 if mask is not None else limit and skips(base, step, best) < limit:
                agenda[i] = _NONE
                skipped += 1
                continue
            sym[i] = s = sym[i] + sym.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(sym[i - 1] + s, _NONE)
            if i < len(agenda):
                agenda[i] = get(s + sym[i + 1], _NONE)
        return sym, skipped

    def _long(self, unit: str, base: int) -> tuple[list[str], int]:
        """The same with a heap, for units of any length."""
        get, skipped, step = self.ranks.get, 0, 0
        sym = list(unit)
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, i, i + 1, 2) for i in range(n - 1) if (r := get(sym[i] + sym[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            rank, i, j, size = heapq.heappop(agenda)
            if not sym[i] or not sym[j] or len(sym[i]) + len(sym[j]) != size:
                continue
            step += 1
            if self.limit and _hash(base, step, rank) < self.limit:
                skipped += 1
                continue
            sym[i] += sym[j]
            sym[j] = ""
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := get(sym[i] + sym[k])) is not None:
                    heapq.heappush(agenda, (r, i, k, len(sym[i]) + len(sym[k])))
            if (h := left[i]) >= 0 and (r := get(sym[h] + sym[i])) is not None:
                heapq.heappush(agenda, (r, h, i, len(sym[h]) + len(sym[i])))
        return [s for s in sym if s], skipped

    def _draw(self, at: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For occurrences of the units with the numbers at: 64 bits of each, and the mask of the candidates that it skips. A unit of n characters that skips k has n - 1 + k candidates at most."""
        with np.errstate(over="ignore"):
            base = _mix(_mix(keys + np.uint64(self.seed & 0xFFFFFFFF) * np.uint64(_SPREAD)) + places * np.uint64(_SPREAD) ^ self.unit_hash[at])
            masks = np.zeros(len(at), np.uint64)
            length = self.unit_length[at]
            live = np.flatnonzero((length > 1) & (length <= _MASKED)) if self.limit else np.empty(0, np.int64)
            left, own, bits, step = length[live] - 1, base[live], masks[live], 0
            while len(live):
                skip = _mix(own + np.uint64((step + 1) * _SPREAD & (1 << 64) - 1)) >> np.uint64(32) < np.uint64(self.limit)
                bits |= skip.astype(np.uint64) << np.uint64(step)
                left = left - ~skip
                step += 1
                on = (left > 0) & (step < 64)
                if not on.all():
                    masks[live[~on]] = bits[~on]
                    live, left, own, bits = live[on], left[on], own[on], bits[on]
        return base, masks

    def _blocks(self, texts: list[str]) -> Iterator[tuple[list[int], list[list[str]], list[int]]]:
        """Rows, their units, and the place of the first of these in its text: all of the short texts at once, the others in blocks."""
        short = [k for k, x in enumerate(texts) if len(x) <= BLOCK]
        yield short, [self.units(f" {texts[k]}") if texts[k] else [] for k in short], [0] * len(short)
        for k, x in enumerate(texts):
            if len(x) > BLOCK:
                found, place = (m.group() for m in self.unit.finditer(f" {x}")), 0
                while units := list(islice(found, BLOCK)):
                    yield [k], [units], [place]
                    place += len(units)

    def encode_batch(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """ids of each text; its key varies what is skipped."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for rows, lists, places in self._blocks(texts):
            for k, ids in zip(rows, self._encode_lists(lists, [keys[k] for k in rows], places), strict=True):
                parts[k].append(ids)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in parts]

    def _encode_lists(self, lists: list[list[str]], keys: list[int], first_places: list[int]) -> list[np.ndarray]:
        """ids of each list of units."""
        if len(self.known) + len(self.number) > CACHE_ENTRIES or self.filled > STORE_IDS:
            self.forget()
        flat = [u for units in lists for u in units]
        number = self.number
        if new := list(set(flat).difference(number)):
            number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
            self.unit_hash = np.append(self.unit_hash, np.array([xxhash.xxh64_intdigest(u) for u in new], np.uint64))
            self.unit_length = np.append(self.unit_length, np.array([len(u) for u in new], np.int64))
            self.whole = np.append(self.whole, np.full(len(new), -1, np.int64))
        n = np.array([len(units) for units in lists], np.int64)
        ends = np.cumsum(n)
        at = np.array(list(map(number.__getitem__, flat)), np.int64)
        places = (np.arange(len(flat)) - np.repeat(ends - n - np.array(first_places, np.int64), n)).astype(np.uint64)
        base, masks = self._draw(at, np.repeat(np.array([k & (1 << 64) - 1 for k in keys], np.uint64), n), places)
        stored = np.full(len(flat), -1, np.int64)
        far = self.unit_length[at] > _MASKED if self.limit else np.zeros(len(flat), bool)  # too many candidates for a mask: each on its own
        plain = np.flatnonzero((masks == 0) & ~far)
        todo = np.unique(at[plain])
        todo = todo[self.whole[todo] < 0]
        if len(todo):
            first = np.empty(len(number), np.int64)
            first[at[plain]] = plain  # some occurrence of each
            units = [flat[k] for k in first[todo].tolist()]
            self.whole[todo] = self._keep(self._encode_units(units, [], [0] * len(units)) if self.limit else self._encode_units(units, [0] * len(units)))
        stored[plain] = self.whole[at[plain]]
        some = np.flatnonzero((masks != 0) & ~far)
        codes, known = list(zip(at[some].tolist(), masks[some].tolist(), strict=True)), self.known
        where = {c: k for c, k in zip(codes, some.tolist(), strict=True) if c not in known}
        if where:
            known.update(zip(where, self._keep(self._encode_units([flat[k] for k in where.values()], [], [c[1] for c in where])).tolist(), strict=True))
        stored[some] = np.array(list(map(known.__getitem__, codes)), np.int64)
        lone = np.flatnonzero(far).tolist()
        if lone:
            stored[far] = self._keep(self._encode_units([flat[k] for k in lone], [int(base[k]) & 0xFFFFFFFF for k in lone]))
        lengths = self.store_length[stored]
        out_ends = np.cumsum(lengths)
        ids = self.store[np.repeat(self.store_start[stored] - (out_ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        cuts = np.concatenate([[0], out_ends])[ends]
        return np.split(ids, cuts[:-1]) if len(cuts) else []

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        return self.encode_batch([text], [key])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the pieces, without the space that encoding put before it."""
        if not len(ids):
            return ""
        parts = []
        for k in range(0, len(ids), BLOCK):
            some = ids[k : k + BLOCK]
            n = self.lengths[some]
            at = np.repeat(self.starts[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            parts.append(self.blob[at].tobytes())
        return b"".join(parts)[1:].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, dropout: float, seed: int) -> Codec:
    return Codec(path, dropout, seed)


def encode_documents(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_pieces, lossless (the ids, decoded, are the text), ids of each row."""
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, dropout, seed)
        try:
            for batch in batches:
                for rows in byte_groups(batch.column(3).to_pylist(), GROUP_BYTES):
                    part = batch.slice(rows.start, len(rows))
                    texts = part.column(2).to_pylist()
                    ids = own.encode_batch(texts, part.column(1).to_pylist())
                    same = [own.decode(got) == text for text, got in zip(texts, ids, strict=True)]
                    counts = np.array([len(x) for x in ids], np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), pa.array(counts), pa.array(same, pa.bool_()), lists], [id_col, "n_bytes", "n_pieces", "lossless", "ids"])
        finally:
            own.forget()  # the worker lives on, and what it looked up would add to the memory of later stages

    key = F.xxhash64(F.col(id_col).cast("string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), key.alias("_key"), text.alias("_text"), F.octet_length(text).cast("long").alias("_bytes"))
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_pieces long, lossless boolean, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """id and text of rows with an array ids; null ids give a null text."""
    id_type = encoded.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, 0.0, SEED)
        for batch in batches:
            texts = [None if x is None else own.decode(np.array(x, np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(F.col(id_col), "ids").mapInArrow(run, f"`{id_col}` {id_type}, text string")
