"""Words, hashes and shingles of whole columns of texts, as NumPy arrays over their UTF-8 bytes.

A chunk of an Arrow string column is handled as one byte array. Words are found by byte class, and hashed with
differences of a running polynomial sum, so that no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def byte_class(inside: bytes | None = None, outside: bytes | None = None) -> np.ndarray:
    """Table of 256 flags: the bytes of ``inside``, or all but those of ``outside``."""
    flags = np.full(256, inside is None)
    flags[list(inside if inside is not None else outside)] = inside is not None
    return flags


#: words are runs of anything but ASCII white space
SPACED = byte_class(outside=b" \t\n\x0b\x0c\r")
#: words are runs of digits, letters a-z (after lower-casing) and all characters beyond ASCII
ALNUM = byte_class(inside=bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_CODE_TABLES = {True: _CODES[LOWER], False: _CODES}


def _power_table(name: str, base: np.uint64, size: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < size:
        table = np.full(max(size, CHUNK_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        have = _powers[name] = np.cumprod(table, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xE9846AF9B1A615D)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class Texts:
    """Some rows of a string column: ``data`` holds their bytes, row i at ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null("")
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, offsets, data = column.buffers()
        n = len(column)
        if n == 0 or offsets is None:
            offsets_array = np.zeros(n + 1, dtype=np.int64)
        else:
            offsets_array = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
        first = offsets_array[0] if n else 0
        self.n = n
        self.offsets = offsets_array - first
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = raw[first : first + self.offsets[-1]] if n else raw[:0]

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Number of set bytes of ``flags`` (one flag per byte) in each row."""
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of set bytes, cut at row ends: (row, start, end)."""
        if not len(inside):
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        edges = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[edges] = inside[edges]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        last = edges[1:] - 1
        closes[last] = inside[last]
        starts = np.flatnonzero(opens)
        return np.searchsorted(self.offsets, starts, side="right") - 1, starts, np.flatnonzero(closes) + 1

    def sums(self, lower: bool) -> np.ndarray:
        """Running polynomial sum of the bytes, for :meth:`hashes`."""
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODE_TABLES[lower][self.data] * _power_table("forward", _BASE, n + 1)[:n], out=sums[1:])
        return sums

    def hashes(self, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span, the same wherever the span lies."""
        back = _power_table("back", _INVERSE, len(self.data) + 1)
        return mix((sums[ends] - sums[starts]) * back[starts])

    def words(self, kind: np.ndarray, lower: bool) -> Words:
        row, starts, ends = self.runs(kind[self.data])
        return Words(self, row, starts, ends, self.hashes(starts, ends, self.sums(lower)))


class Words:
    """Words of :class:`Texts` in order: row, byte span and hash of each; ``bounds`` gives each row's first word."""

    def __init__(self, texts: Texts, row: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        self.texts, self.row, self.starts, self.ends, self.hashes = texts, row, starts, ends, hashes
        self.counts = np.bincount(row, minlength=texts.n).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all n-word runs that stay in their row, and the runs' hashes."""
        size = len(self.hashes) - n + 1
        if size <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        value = np.zeros(size, dtype=np.uint64)
        for k in range(n):
            value *= _GRAM
            value += self.hashes[k : k + size]
        first = np.flatnonzero(self.row[:size] == self.row[n - 1 :])
        return first, mix(value[first])


def whole(hashes: np.ndarray) -> int:
    """Hash of one run of words, equal to that of :meth:`Words.grams` of the same length."""
    value = 0
    for h in hashes.tolist():
        value = (value * int(_GRAM) + h) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([value], dtype=np.uint64))[0])


def salted(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that also depend on the row, to tell repeats within a row from repeats elsewhere."""
    return mix(hashes + (row.astype(np.uint64) + np.uint64(1)) * _BASE)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches that hold about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        texts = Texts(batch.column(column))
        lo = 0
        while lo < texts.n:
            hi = int(np.searchsorted(texts.offsets, texts.offsets[lo] + limit, side="right")) - 1
            hi = max(lo + 1, min(hi, texts.n))
            part = batch.slice(lo, hi - lo)
            yield part, Texts(part.column(column))
            lo = hi


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Batches of whole groups, from rows sorted by ``keys`` (integers), with the number of each row's group in its batch."""

    def numbered(waiting: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.RecordBatch]:
        batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        edge = np.zeros(batch.num_rows, dtype=bool)
        for c in keys:
            edge[1:] |= np.diff(np.asarray(batch.column(c))) != 0
        return np.cumsum(edge), batch

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [np.asarray(batch.column(c)) for c in keys]
        if waiting and any(waiting[-1].column(c)[-1].as_py() != x[0] for c, x in zip(keys, ids, strict=True)):
            yield numbered(waiting)
            waiting = []
        change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1
        if len(change):
            cut = int(change[-1])
            yield numbered([*waiting, batch.slice(0, cut)])
            waiting, batch = [], batch.slice(cut)
        waiting.append(batch)
    if waiting:
        yield numbered(waiting)


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return values.view(np.int64)
