"""Alignment of two tokenizers' output: texts are cut where a token of each ends at the same byte.

The cuts of a batch of texts are found by divide and conquer. Every open interval is probed near its middle, bisecting the
other side's ends for each probed end; at the first shared end it falls into two intervals, and an interval without one
is a group. All intervals of a batch advance together, so a step is a few array operations.

The ids that end together at a cut are linked. How often two ids are linked in the whole corpus tells which id of one
vocabulary usually stands for one of the other; each document gets the sum of those counts and its number of best links.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text, stored
from spherecube.llm.packing import Encoder

#: up to this many linked id pairs (16 bytes each) are sent to every task; more are joined by shuffle
PAIR_LIMIT = 2_000_000
#: bytes of text a task takes apart at a time, at about 150 bytes of arrays for each
CHUNK_BYTES = 1 << 20
_SPACE = 0x20


class TokenBytes:
    """Byte length of every token of a vocabulary, and the bytes themselves."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of the tokens."""
        length = self.lengths[ids]
        return self.data[np.repeat(self.starts[ids] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]


class ByteEncoder(Encoder):
    """Byte-level ids; the names of special tokens inside texts are plain text."""

    lossy = False

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        # ids of bytes that no text holds stay empty
        tokens = [b""] * self.tokenizer.get_vocab_size()
        for i in range(len(tokens)):
            with contextlib.suppress(KeyError):
                tokens[i] = self.ranked.decode_single_token_bytes(i)
        self.bytes = TokenBytes(tokens)


class PieceEncoder(Encoder):
    """Ids of a sentencepiece model that adds one space before a text, for texts that begin with that space.

    No piece of the model joins a space to a character before it, so that texts may be cut before runs of spaces. Equal
    cuts are encoded once. A model for which that doesn't hold is refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces reach over spaces")
        self.bytes = TokenBytes([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.space = self.model.piece_to_id("▁")
        self.lossy = False
        self._reset()

    def _cuts(self, texts: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
        space = texts.data == _SPACE
        opens = space.copy()
        opens[1:] &= ~space[:-1]
        opens[texts.offsets[:-1][texts.offsets[:-1] < texts.offsets[1:]]] = True
        starts = np.flatnonzero(opens)
        return starts, np.append(starts[1:], len(texts.data)) if len(starts) else starts

    def _learn(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        cuts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        made = self.model.encode([cut[1:].decode(errors="replace") for cut in cuts], num_threads=1)
        # the space before nothing isn't added
        made = [ids if ids or len(cut) > 1 else [self.space] for ids, cut in zip(made, cuts, strict=True)]
        sizes = np.array([len(ids) for ids in made], dtype=np.int64)
        flat = np.array([i for ids in made for i in ids], dtype=np.uint32)
        if self.bytes.of(flat).tobytes() != b"".join(cuts):
            self.lossy = True
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])


@lru_cache(maxsize=4)
def _encoder(kind: type, path: str) -> Encoder:
    return kind(path)


def _tokens(encoder: Encoder, texts: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, their bounds, and whether each text's joined token bytes are its own."""
    ids, bounds = encoder.encode(texts, 0)
    keep = np.ones(len(ids), dtype=bool)
    keep[bounds[1:] - 1] = False
    ids, bounds = ids[keep].astype(np.int64), bounds - np.arange(len(bounds))
    total = np.concatenate([[0], np.cumsum(encoder.bytes.lengths[ids])])[bounds]
    same = np.diff(total) == np.diff(texts.offsets)
    if encoder.lossy:
        joined = encoder.bytes.of(ids)
        for k in np.flatnonzero(same).tolist():
            same[k] = np.array_equal(joined[total[k] : total[k + 1]], texts.data[texts.offsets[k] : texts.offsets[k + 1]])
    return ids, bounds, same


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, one range after the other, and the range each belongs to."""
    sizes = np.maximum(ends - starts, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), owner


def _middle_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval of tokens ``lo..hi - 1`` the one nearest the middle whose end is shared, and the place of that
    end on the other side; -1 where none is. Rings around the middle are probed, each twice as wide as all before."""
    cut, place = np.full(len(lo), -1, dtype=np.int64), np.full(len(lo), -1, dtype=np.int64)
    middle = (lo + hi - 1) // 2
    left, near, far = np.flatnonzero(hi > lo), 0, 1
    while len(left):
        m, a, b = middle[left], lo[left], hi[left]
        probe, owner = _ranges(np.concatenate([np.maximum(a, m - far + 1), np.maximum(m + max(near, 1), a)]), np.concatenate([m - near + 1, np.minimum(b, m + far)]))
        owner %= len(left)
        at = np.minimum(np.searchsorted(ends_b, ends_a[probe]), len(ends_b) - 1)
        hit = ends_b[at] == ends_a[probe]
        probe, owner, at = probe[hit], owner[hit], at[hit]
        order = np.lexsort((np.abs(probe - m[owner]), owner))
        owner = owner[order]
        opens = np.flatnonzero(np.diff(owner, prepend=-1))
        first, found = order[opens], left[owner[opens]]
        cut[found], place[found] = probe[first], at[first]
        open_ = (cut[left] < 0) & ((m - far >= a) | (m + far < b))
        left, near, far = left[open_], far, 3 * far
    return cut, place


def shared_groups(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last token of every group on either side, in order of the text.

    ``ends`` are rising byte offsets over all texts; a text's tokens lie at ``bounds[i]:bounds[i + 1]``, and its last
    tokens end together.
    """
    filled = np.flatnonzero(np.diff(bounds_a) > 0)
    a, b = (bounds_a[filled], bounds_a[filled + 1]), (bounds_b[filled], bounds_b[filled + 1])
    done_a, done_b = [], []
    while len(a[0]):
        cut, place = _middle_cuts(ends_a, ends_b, a[0], a[1] - 1)
        leaf = cut < 0
        done_a.append(a[1][leaf] - 1)
        done_b.append(b[1][leaf] - 1)
        cut, place, more = cut[~leaf] + 1, place[~leaf] + 1, ~leaf
        a = (np.concatenate([a[0][more], cut]), np.concatenate([cut, a[1][more]]))
        b = (np.concatenate([b[0][more], place]), np.concatenate([place, b[1][more]]))
        small = (a[1] - a[0] == 1) | (b[1] - b[0] == 1)
        done_a.append(a[1][small] - 1)
        done_b.append(b[1][small] - 1)
        a, b = (a[0][~small], a[1][~small]), (b[0][~small], b[1][~small])
    if not done_a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.sort(np.concatenate(done_a)), np.sort(np.concatenate(done_b))


def _written(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All groups as text, ``a1,a2|b1;``, and for each side the offset behind each token's separator."""
    group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
    group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
    before_b = np.concatenate([[0], last_b + 1])
    at_a, at_b = np.arange(len(ids_a)) + before_b[group_a], np.arange(len(ids_b)) + last_a[group_b] + 1
    ids, mark = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64), np.full(len(ids_a) + len(ids_b), ord(","), dtype=np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
    digits = np.ones(len(ids), dtype=np.int64)
    top = 10
    while len(ids) and top <= ids.max():
        digits += ids >= top
        top *= 10
    behind = np.cumsum(digits + 1)
    out = np.zeros(int(behind[-1]) if len(behind) else 0, dtype=np.uint8)
    out[behind - 1] = mark
    rest, at, left = ids, behind - 2, digits
    while len(rest):
        out[at] = rest % 10 + ord("0")
        more = left > 1
        rest, at, left = rest[more] // 10, at[more] - 1, left[more] - 1
    return out.tobytes(), behind[at_a], behind[at_b]


def _keep_rows(ids: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.where(keep, np.diff(bounds), 0)
    return ids if keep.all() else ids[np.repeat(keep, np.diff(bounds))], np.concatenate([[0], np.cumsum(sizes)])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _aligned(part: pa.RecordBatch, texts: tx.Texts, one: Encoder, other: Encoder, with_groups: bool) -> pa.RecordBatch:
    ids_a, bounds_a, fine_a = _tokens(one, texts)
    ids_b, bounds_b, fine_b = _tokens(other, texts)
    fine = fine_a & fine_b
    (ids_a, bounds_a), (ids_b, bounds_b) = _keep_rows(ids_a, bounds_a, fine), _keep_rows(ids_b, bounds_b, fine)
    last_a, last_b = shared_groups(np.cumsum(one.bytes.lengths[ids_a]), np.cumsum(other.bytes.lengths[ids_b]), bounds_a, bounds_b)
    groups = np.searchsorted(last_a, bounds_a)
    text, _, behind_b = _written(ids_a, ids_b, last_a, last_b)
    begin = np.concatenate([[0], behind_b])[bounds_b]
    hashes = [hashlib.sha256(text[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    # equal links of a text become one with their number
    link = (ids_a[last_a] << 32) | ids_b[last_b]
    row = np.repeat(np.arange(texts.n), np.diff(groups))
    order = np.lexsort((link, row))
    link, row = link[order], row[order]
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(link, prepend=-1) != 0))
    times = np.diff(np.append(first, len(link)))
    bounds = np.searchsorted(row[first], np.arange(texts.n + 1))
    columns = {
        "doc_id": part.column("doc_id"), "n_a": pa.array(np.diff(bounds_a)), "n_b": pa.array(np.diff(bounds_b)),
        "n_groups": pa.array(np.diff(groups)), "n_links": pa.array(np.diff(groups)), "groups_sha256": pa.array(hashes, pa.string()),
        "link_a": _lists(link[first] >> 32, bounds), "link_b": _lists(link[first] & 0xFFFFFFFF, bounds), "link_times": _lists(times, bounds),
    }
    if with_groups:
        end_a, end_b = last_a + 1 - np.repeat(bounds_a[:-1], np.diff(groups)), last_b + 1 - np.repeat(bounds_b[:-1], np.diff(groups))
        columns |= {"a_ids": _lists(ids_a, bounds_a), "b_ids": _lists(ids_b, bounds_b), "a_ends": _lists(end_a, groups), "b_ends": _lists(end_b, groups)}
    return pa.RecordBatch.from_pydict(columns)


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, link_a, link_b, link_times and, if
    asked for, a_ids, b_ids, a_ends, b_ends.

    Space and text are encoded by the byte-level vocabulary at ``a_path`` and the sentencepiece model at ``b_path``; the
    latter adds that space itself. Group g holds the tokens ``a_ends[g - 1]`` to ``a_ends[g] - 1`` of one side and the like
    of the other. ``link_*`` are the distinct pairs of ids that end together, with how often they do so.
    Null and empty texts, and texts that a tokenizer changes, have no tokens: counts are 0, lists and the digest empty.
    Repeated rows come as often as they are there. A task takes about 1 MB of text at a time, or one text if that is longer.
    """
    spaced = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("")
    rows = id_and_text(docs, id_col, text_col).withColumn("text", spaced)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = _encoder(ByteEncoder, a_path), _encoder(PieceEncoder, b_path)
        for part, texts in tx.chunks(batches, "text", CHUNK_BYTES):
            yield _aligned(part, texts, one, other, with_groups)

    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    schema += ", link_a array<int>, link_b array<int>, link_times array<int>"
    return rows.mapInArrow(compute, schema + (", a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>" if with_groups else ""))


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair key, number of times and row of all links of a batch."""
    a, b, times = (batch.column(c) for c in ("link_a", "link_b", "link_times"))
    flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b, times)]
    return (flat[0] << 32) | flat[1], flat[2], np.repeat(np.arange(len(batch)), a.value_lengths().to_numpy(zero_copy_only=False))


def link_counts(aligned: DataFrame) -> DataFrame:
    """How often each pair of ids is linked in all documents (``pair``: one id in the upper, one in the lower 32 bits;
    ``count``), and whether that is the most of all pairs with the same lower id (``best``; ties are all best)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, times, _ = _keys(batch)
            pair, at = np.unique(keys, return_inverse=True)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair), "count": pa.array(np.bincount(at, weights=times, minlength=len(pair)).astype(np.int64))})

    pairs = aligned.select("link_a", "link_b", "link_times").mapInArrow(compute, "pair bigint, count bigint").groupBy("pair").agg(F.sum("count").alias("count"))
    pairs = stored(pairs, "links")
    lower = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = pairs.groupBy(lower.alias("_b")).agg(F.max("count").alias("_most"))
    return pairs.join(most, lower == F.col("_b")).select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))


def _scored_in_tasks(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Look every link up in the whole pair table, which is small by its counted rows."""
    table = counts.orderBy("pair").toArrow()
    table = [table.column(c).to_numpy() for c in ("pair", "count", "best")]
    sent = aligned.sparkSession.sparkContext.broadcast(table)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = sent.value
        for batch in batches:
            keys, times, row = _keys(batch)
            at = np.searchsorted(pair, keys)
            # sums of integers in float64 would be exact only up to 2**53
            total, good = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            np.add.at(total, row, count[at] * times)
            np.add.at(good, row, np.where(best[at], times, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good), pa.array(total)], names=[*batch.schema.names, "n_best", "count_sum"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in aligned.dtypes)
    return aligned.mapInArrow(compute, f"{kinds}, n_best bigint, count_sum bigint")


def _scored_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join of all links with the pair table; rows are told apart by their place in the stored files."""
    rows = aligned.withColumn("_at", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("k")))
    link = F.explode(F.arrays_zip("link_a", "link_b", "link_times"))
    links = rows.select("_at", link.alias("_l")).select("_at", (F.shiftleft(F.col("_l.link_a").cast("bigint"), 32) + F.col("_l.link_b")).alias("pair"), F.col("_l.link_times").alias("_n"))
    scores = links.join(counts, "pair").groupBy("_at").agg(F.sum(F.when(F.col("best"), F.col("_n")).otherwise(0)).cast("bigint").alias("n_best"), F.sum(F.col("count") * F.col("_n")).alias("count_sum"))
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return rows.join(scores, "_at", "left").select(*aligned.columns, *zero)


def aligned_and_scored(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                       with_groups: bool = True, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """The columns of :func:`alignments`, then n_best (links whose pair is linked as often in all documents as any with the
    same id of the second vocabulary) and count_sum (those numbers summed over the document's links). Texts are encoded
    once; ids and links are kept in the shared folder between the two passes. An empty table gives an empty table.

    The pair table is counted first. Up to ``pair_limit`` rows it goes to the tasks whole, beyond that links are joined by
    shuffle; both give the same rows.
    """
    aligned = stored(alignments(docs, a_path, b_path, id_col, text_col, with_groups), "aligned")
    counts = stored(link_counts(aligned), "link-counts")
    return (_scored_in_tasks if counts.count() <= pair_limit else _scored_by_join)(aligned, counts)
