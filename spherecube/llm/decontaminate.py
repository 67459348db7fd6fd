"""Benchmark decontamination by winnowing.

Every window of ``window`` words shares the minimum of its k-gram hashes with any equal window, so texts that share
such a span share a fingerprint. Fingerprints of items and documents are joined; around a shared fingerprint the hit is
extended to the full windows that hold it, and those are looked up whole. Items shorter than a window are one
window each; they are winnowed with k equal to their length, once for every such length that occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text, schema_with, stored

WINDOW = 10
GRAM = 5
#: item windows up to this many (of 16 bytes) go to every task; more are joined by shuffle
BROADCAST_WINDOWS = 4_000_000


def fingerprints(words: tx.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-grams: (word position, hash) of the minimum, the last of equals, of every full window."""
    position, grams = words.grams(gram)
    span = window - gram + 1
    size = len(position) - span + 1
    if size <= 0:
        return position[:0], grams[:0]
    best, arg = grams[:size].copy(), np.arange(size)
    for k in range(1, span):
        nxt = grams[k : k + size]
        take = nxt <= best
        best[take] = nxt[take]
        arg[take] = np.flatnonzero(take) + k
    same_row = words.row[position[:size]] == words.row[position[span - 1 :]]
    chosen = np.unique(arg[same_row])
    return position[chosen], grams[chosen]


def _lengths(items: tx.Words, window: int) -> np.ndarray:
    return np.unique(np.minimum(items.counts[items.counts > 0], window))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: item_id, length, hash."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            words = texts.words(tx.ALNUM, lower=True)
            ids = part.column("doc_id")
            for n in _lengths(words, window).tolist():
                position, value = words.grams(n)
                row = words.row[position]
                fits = np.ones(len(row), dtype=bool) if n == window else words.counts[row] == n
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[fits])), pa.array(np.full(fits.sum(), n, dtype=np.int32)), pa.array(tx.signed(value[fits]))],
                    names=["item_id", "length", "hash"],
                )

    kind = dict(benchmark.dtypes)["doc_id"]
    return benchmark.mapInArrow(compute, f"item_id {kind}, length int, hash bigint").distinct()


def item_fingerprints(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Distinct fingerprints of the items of a full window or more: hash."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in tx.chunks(batches, "text"):
            _, value = fingerprints(texts.words(tx.ALNUM, lower=True), window, gram)
            yield pa.RecordBatch.from_arrays([pa.array(tx.signed(np.unique(value)))], names=["hash"])

    return benchmark.mapInArrow(compute, "hash bigint").distinct()


def _candidates(words: tx.Words, known: np.ndarray | None, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows around shared fingerprints, and the fingerprint each comes from."""
    position, value = fingerprints(words, window, gram)
    if known is not None:
        hit = _found(value, known)
        position, value = position[hit], value[hit]
    back = window - gram
    starts = (position[:, None] - np.arange(back, -1, -1)).ravel()
    row = np.repeat(words.row[position], back + 1)
    fits = (starts >= words.bounds[row]) & (starts + window <= words.bounds[row + 1])
    return starts[fits], np.repeat(value, back + 1)[fits]


def _found(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _window_hashes(words: tx.Words, starts: np.ndarray, n: int) -> np.ndarray:
    value = np.zeros(len(starts), dtype=np.uint64)
    for k in range(n):
        value *= tx._GRAM
        value += words.hashes[starts + k]
    return tx.mix(value)


def _covered(words: tx.Words, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words of each row that lie in any of the windows."""
    steps = np.zeros(len(words.row) + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, starts + lengths, 1)
    return np.bincount(words.row[np.cumsum(steps[:-1]) > 0], minlength=words.texts.n).astype(np.int64)


class _Lookup:
    """Item windows and fingerprints as sorted arrays, sent once to every executor."""

    def __init__(self, windows: dict[int, tuple[np.ndarray, np.ndarray]], marks: np.ndarray):
        self.windows, self.marks = windows, marks


def _small(benchmark_windows, marks, window: int) -> _Lookup:
    by_length = {}
    for n, group in benchmark_windows.groupby("length"):
        group = group.assign(hash=group["hash"].to_numpy().view(np.uint64)).sort_values("hash", kind="stable")
        by_length[int(n)] = (group["hash"].to_numpy(), group["item_id"].astype(str).to_numpy(dtype=object))
    return _Lookup(by_length, np.sort(marks["hash"].to_numpy().view(np.uint64)))


def _scan(lookup: _Lookup, words: tx.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of item windows: (first word, length, index in the windows of that length)."""
    out = []
    for n, (known, _) in lookup.windows.items():
        if n == window:
            starts = np.unique(_candidates(words, lookup.marks, window, gram)[0])
            value = _window_hashes(words, starts, n)
        else:
            starts, value = words.grams(n)  # with k equal to the window every gram is a fingerprint
        hit = _found(value, known)
        starts, value = starts[hit], value[hit]
        out.append((starts, np.full(len(starts), n, dtype=np.int64), value))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
             window: int = WINDOW, gram: int = GRAM, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``_leak``: n_words, n_hit, n_items (bigint) and item_ids (sorted strings).

    One row for each input row, all input columns kept. Words are runs of digits, lower-cased A-Z and characters beyond
    ASCII. A null or empty text has no words and no hits; an item without words has no window; equal items each count
    under their own id, an item id given twice counts once. An empty benchmark hits nothing. The benchmark's windows
    are counted first: up to ``broadcast_windows`` they go to every task, beyond that :func:`annotate_by_join` runs.
    """
    docs = docs.select(*[c for c in docs.columns if c != "_leak"])
    items = id_and_text(benchmark, item_col, item_text_col).dropna(subset=["doc_id"])
    windows = stored(item_windows(items, window), "item-windows")
    if windows.count() > broadcast_windows:
        return annotate_by_join(docs, items, windows, text_col, window, gram)
    lookup = _small(windows.toPandas(), item_fingerprints(items, window, gram).toPandas(), window)
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part, texts in tx.chunks(batches, text_col):
            words = texts.words(tx.ALNUM, lower=True)
            starts, lengths, value = _scan(table, words, window, gram)
            names: list[list[str]] = [[] for _ in range(texts.n)]
            order = np.lexsort((value, lengths, words.row[starts]))
            seen = np.unique(np.stack([words.row[starts][order], lengths[order], tx.signed(value[order])]), axis=1)
            found: dict[int, set[str]] = {}
            for row, n, v in seen.T.tolist():
                known, ids = table.windows[n]
                key = np.uint64(v & 0xFFFFFFFFFFFFFFFF)
                found.setdefault(row, set()).update(ids[np.searchsorted(known, key) : np.searchsorted(known, key, side="right")])
            for row, ids in found.items():
                names[row] = sorted(ids)
            leak = pa.StructArray.from_arrays(
                [pa.array(words.counts), pa.array(_covered(words, starts, lengths)), pa.array([len(x) for x in names], pa.int64()), pa.array(names, pa.list_(pa.string()))],
                names=["n_words", "n_hit", "n_items", "item_ids"],
            )
            yield pa.RecordBatch.from_arrays([*part.columns, leak], names=[*part.schema.names, "_leak"])

    return docs.mapInArrow(compute, schema_with(docs, "_leak struct<n_words: bigint, n_hit: bigint, n_items: bigint, item_ids: array<string>>"))


def annotate_by_join(docs: DataFrame, items: DataFrame, windows: DataFrame, text_col: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """:func:`annotate` for item tables too large to send to every task: fingerprints and windows meet in shuffles.

    The rows get a number that is stored with them, so that repeated ids don't mix.
    """
    spark = docs.sparkSession
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    lengths = [r[0] for r in windows.select("length").distinct().collect()]
    short = sorted(n for n in lengths if n < window)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "_text"):
            words = texts.words(tx.ALNUM, lower=True)
            rows = np.asarray(part.column("_row"))

            def made(starts, length, value, mark):
                local = words.row[starts]
                return pa.RecordBatch.from_arrays(
                    [pa.array(rows[local]), pa.array(starts - words.bounds[local]), pa.array(np.full(len(starts), length, dtype=np.int32)), pa.array(tx.signed(value)), pa.array(tx.signed(mark)), pa.array(words.counts[local])],
                    names=["_row", "start", "length", "hash", "mark", "n_words"],
                )

            starts, mark = _candidates(words, None, window, gram)
            yield made(starts, window, _window_hashes(words, starts, window), mark)
            for n in short:
                starts, value = words.grams(n)
                yield made(starts, n, value, value)

    counted = numbered.select("_row", F.col(text_col).cast("string").alias("_text"))
    spans = counted.mapInArrow(emit, "_row bigint, start bigint, length int, hash bigint, mark bigint, n_words bigint")
    marks = item_fingerprints(items, window, gram).select(F.lit(window).alias("length"), F.col("hash").alias("mark"))
    marks = marks.union(windows.filter(F.col("length") < window).select("length", F.col("hash").alias("mark"))).distinct()
    near = spans.join(marks, ["length", "mark"], "left_semi").select("_row", "start", "length", "hash").distinct()
    hits = stored(near.join(windows, ["length", "hash"]).select("_row", "start", "length", F.col("item_id").cast("string").alias("item")), "leaks")
    item_sets = hits.groupBy("_row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    cover = hits.groupBy("_row").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    # spans sorted by start: add what each reaches beyond the furthest end so far
    total = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("bigint"), x["end"] - F.greatest(x["start"], a["reach"]))).alias("n"), F.greatest(a["reach"], x["end"]).alias("reach")),
    )["n"]
    cover = cover.select("_row", total.alias("n_hit"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "_text"):
            yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(texts.words(tx.ALNUM, lower=True).counts)], names=["_row", "n_words"])

    sizes = counted.mapInArrow(count, "_row bigint, n_words bigint")
    leak = F.struct(
        "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("bigint").alias("n_items"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
    joined = sizes.join(cover, "_row", "left").join(item_sets, "_row", "left").select("_row", leak.alias("_leak"))
    return numbered.join(joined, "_row").drop("_row")
