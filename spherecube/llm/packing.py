"""Packing of token sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents are dealt to partitions by a hash of their content and taken in groups as they stream through a task. In a
group, a document's whole multiples of the sequence length are sequences of their own; the remainders are sorted by
falling length, and each goes to the first open sequence with room, found by descending a tree of maxima.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text

SEQUENCE = 1024
GROUP_DOCS = 4096
GROUP_TOKENS = 8_000_000
CACHE_PIECES = 2_000_000
END_OF_TEXT = 0
#: fixed values: how byte-level vocabularies split a text before the merges, and a mark between cuts
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BREAK = "<|endoftext|>"

#: last bytes of white space characters beyond ASCII are told by the bytes before them
_WIDE_SPACE = {(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A, 0x80), (0xE2, 0x81, 0x9F), (0xE3, 0x80, 0x80), *((0xE2, 0x80, x) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF))}


class BinTree:
    """Room left in each bin, with the maximum of every pair, pair of pairs and so on: first bin with room in O(log n)."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, length: int) -> tuple[int, int]:
        """Place in the first bin with room: (bin, room it had)."""
        room, at = self.room, 1
        if room[1] < length:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        had, found = room[at], at - self.leaves
        room[at] = had - length
        at //= 2
        while at:
            left, right = room[2 * at], room[2 * at + 1]
            top = left if left > right else right
            if room[at] == top:
                break
            room[at] = top
            at //= 2
        return found, had


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; pieces of equal length go in their order. Lengths lie in 1..capacity."""
    tree = BinTree(len(lengths), capacity)
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        bins[k], had = tree.put(int(lengths[k]))
        offsets[k] = capacity - had
    return bins, offsets


class Slots:
    """Open-addressing table from 64-bit hashes to consecutive numbers, filled and read by arrays."""

    def __init__(self, limit: int):
        self.mask = np.uint64((1 << (2 * limit - 1).bit_length()) - 1)
        self.keys = np.zeros(int(self.mask) + 1, dtype=np.uint64)
        self.values = np.full(int(self.mask) + 1, -1, dtype=np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where it has none."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        at = hashes & self.mask
        left = np.arange(len(hashes))
        while len(left):
            got = self.values[at]
            same = self.keys[at] == hashes[left]
            out[left[same]] = got[same]
            more = ~same & (got >= 0)
            left, at = left[more], (at[more] + np.uint64(1)) & self.mask
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number distinct hashes that are not yet in the table."""
        numbers = self.size + np.arange(len(hashes))
        self.size += len(hashes)
        at, left = hashes & self.mask, np.arange(len(hashes))
        while len(left):
            free = np.flatnonzero(self.values[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.values[at[won]] = hashes[left[won]], numbers[left[won]]
            stay = np.ones(len(left), dtype=bool)
            stay[won] = False
            left, at = left[stay], (at[stay] + np.uint64(1)) & self.mask
        return numbers


class Encoder:
    """Token ids of texts, as ``tokenizers`` gives them without special tokens.

    The vocabulary's pre-tokenizer never joins a word to the white space after it, so a text may be cut before
    white space that follows a word. Equal cuts are encoded once and kept in a bounded table. New cuts go through
    ``tiktoken`` with the ranks of the same file, which gives the same ids in a third of the time; those that may hold
    the name of a special token go through ``tokenizers``.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # how a byte-level vocabulary writes bytes as characters, asked of the library itself
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        byte_of = {}
        for text in [*map(chr, range(0x800)), *(chr(k << 12) for k in range(1, 16) if k != 13), "\u0800", *(chr(k << 18) for k in range(1, 4)), "\U00010000", "\U00100000"]:
            byte_of |= zip(level.pre_tokenize_str(text)[0][0], text.encode(), strict=True)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        # ids follow the order of the merges, so they serve as ranks
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if all(c in byte_of for c in token) and token != BREAK}
        self.ranked = tiktoken.Encoding("byte_level", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={BREAK: len(vocabulary)})
        self.break_id = len(vocabulary)
        self._reset()

    def _reset(self) -> None:
        self.slots = Slots(CACHE_PIECES)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _cuts(self, texts: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data
        space = ~tx.SPACED[data]
        after = space.copy()
        for pattern in _WIDE_SPACE:
            hits = np.flatnonzero(data[: max(len(data) - len(pattern) + 1, 0)] == pattern[0]) if len(data) else np.zeros(0, dtype=np.int64)
            for k, byte in enumerate(pattern[1:], 1):
                hits = hits[data[hits + k] == byte]
            after[hits + len(pattern) - 1] = True
        opens = np.zeros(len(data), dtype=bool)
        opens[1:] = space[1:] & ~after[:-1]
        opens[texts.offsets[:-1][texts.offsets[:-1] < texts.offsets[1:]]] = True
        starts = np.flatnonzero(opens)
        return starts, np.append(starts[1:], len(data)) if len(starts) else starts

    def _learn(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        whole = [k for k, piece in enumerate(pieces) if b"<|" in piece]
        made = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[k].decode() for k in whole], add_special_tokens=False)]
        for k in whole:
            pieces[k] = b""
        flat = self.ranked.encode_to_numpy(BREAK.encode().join(pieces).decode(), allowed_special={BREAK}).astype(np.uint32)
        marks = np.append(np.flatnonzero(flat == self.break_id), len(flat))
        sizes = np.diff(marks, prepend=-1) - 1
        flat = flat[flat != self.break_id]
        for k, ids in zip(whole, made, strict=True):
            at = int(sizes[:k].sum())
            flat = np.concatenate([flat[:at], np.array(ids, dtype=np.uint32), flat[at:]])
            sizes[k] = len(ids)
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def encode(self, texts: tx.Texts, extra: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by ``extra``, and the bounds of the texts among them."""
        starts, ends = self._cuts(texts)
        row = np.searchsorted(texts.offsets, starts, side="right") - 1
        hashes = texts.hashes(starts, ends, texts.sums(lower=False))
        slot = self.slots.find(hashes)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            keys, first, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            if self.slots.size + len(keys) > CACHE_PIECES:
                self._reset()
                if len(missing) < len(hashes):
                    missing = np.arange(len(hashes))
                    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                if len(keys) > CACHE_PIECES:
                    self.slots = Slots(len(keys))
            number = self.slots.add(keys)
            self._learn(texts.data.tobytes(), starts[missing[first]], ends[missing[first]])
            slot[missing] = number[inverse]
        begin, length = self.ends[slot], self.ends[slot + 1] - self.ends[slot]
        per_row = np.bincount(row, weights=length, minlength=texts.n).astype(np.int64) + 1
        bounds = np.concatenate([[0], np.cumsum(per_row)])
        # each cut's ids go behind those before it; one place is left at the end of every row
        behind = np.cumsum(length) - length
        step = np.arange(int(length.sum()))
        out = np.full(bounds[-1], extra, dtype=np.uint32)
        out[step + np.repeat(row, length)] = self.ids[step + np.repeat(begin - behind, length)]
        return out, bounds


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _packed(groups: list[tuple[pa.Array, np.ndarray, np.ndarray]], capacity: int, next_sequence: int, with_ids: bool):
    """Cut the documents of one group and place the pieces: a record batch and the next free sequence number."""
    doc_ids = pa.concat_arrays([g[0] for g in groups])
    sizes = np.concatenate([np.diff(g[2]) for g in groups])
    ids = np.concatenate([g[1] for g in groups])
    base = np.cumsum(sizes) - sizes
    pieces = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
    length = np.minimum(capacity, sizes[doc] - start)
    sequence, offset = np.zeros(len(doc), dtype=np.int64), np.zeros(len(doc), dtype=np.int64)
    full = length == capacity
    sequence[full] = np.arange(full.sum())
    if not full.all():
        bins, offset[~full] = first_fit_decreasing(length[~full], capacity)
        sequence[~full] = bins + full.sum()
    at = base[doc] + start
    little = ids.astype("<u4", copy=False)
    crc = np.array([zlib.crc32(little[a : a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)], dtype=np.int64)
    columns = [doc_ids.take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc), pa.array(sizes[doc]), pa.array(sequence + next_sequence), pa.array(offset)]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names), next_sequence + (int(sequence.max()) + 1 if len(sequence) else 0)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE,
         group_docs: int = GROUP_DOCS, group_tokens: int = GROUP_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A document's ids are followed by id 0. Null and empty texts have that id alone. Repeated rows are packed as often
    as they come, under the same doc_id. Sequences hold ``capacity`` ids at most; what is missing at their end is padding.
    ``sequence_id`` holds the partition number in its upper bits; a partition's content follows from the rows alone.
    Memory: a group is closed at ``group_docs`` documents or ``group_tokens`` ids, whatever comes first.
    """
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.repartition(F.xxhash64("doc_id", "text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_path).encode
        sequence = TaskContext.get().partitionId() << 40
        group: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n_docs = n_tokens = 0
        for part, texts in tx.chunks(batches, "text"):
            ids, bounds = encode(texts, END_OF_TEXT)
            group.append((part.column("doc_id"), ids, bounds))
            n_docs, n_tokens = n_docs + texts.n, n_tokens + len(ids)
            if n_docs >= group_docs or n_tokens >= group_tokens:
                batch, sequence = _packed(group, capacity, sequence, with_ids)
                yield batch
                group, n_docs, n_tokens = [], 0, 0
        if group:
            yield _packed(group, capacity, sequence, with_ids)[0]

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(compute, schema + (", ids array<int>" if with_ids else ""))
