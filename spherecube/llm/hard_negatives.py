"""Hard negatives by exact inner products: residue-number-system GEMM, then selection inside score windows.

Components are integers. Their residues modulo a few primes near 1000 are multiplied as float32 matrices, 64 columns at a
time, so that every partial sum stays below 2**24 and is exact. The signed score is rebuilt from its residues by Chinese
remaindering with digits around zero. As many primes are used as the norms of a block ask for.

The anchors fall into blocks and all rows into slices; a task holds one block and streams the rows of one slice past it.
A first pass finds each anchor's positives, a second the negatives inside the window of every positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spherecube.llm.common import stored

#: anchors a task holds, and rows of a slice at most
ANCHOR_BLOCK = 4096
SLICE_ROWS = 1_000_000
#: scores a task holds at a time
CELLS = 2_000_000
#: fixed values: 64 products of two residues of at most 510 stay below 2**24
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
WIDTH = 64
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _around_zero(values: np.ndarray, p: int) -> np.ndarray:
    """Residues in -(p - 1) / 2 .. (p - 1) / 2 of whole numbers in float64."""
    return values - p * np.rint(values / p)


class Residues:
    """Rows of whole numbers as float32 residues modulo each prime, made when first asked for."""

    def __init__(self, values: np.ndarray):
        self.values, self.made = values, {}
        self.norm = math.sqrt(float((values.astype(np.float64) ** 2).sum(axis=1).max())) if values.size else 0.0

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.made:
            rest = np.mod(self.values, p)
            self.made[p] = (rest - p * (rest > p // 2)).astype(np.float32)
        return self.made[p]


def primes_for(bound: int) -> tuple[int, ...]:
    """The first primes whose product tells all scores between ``-bound`` and ``bound`` apart."""
    if bound > _MOST:
        raise OverflowError("scores don't fit 64 bits")
    size, product = 0, 1
    while product < 2 * bound + 1:
        product *= PRIMES[size]
        size += 1
    return PRIMES[: max(size, 1)]


def exact_scores(a: Residues, b: Residues) -> np.ndarray:
    """All inner products of the rows of ``a`` and ``b``, exact in 64 bits."""
    primes = primes_for(math.ceil(a.norm * b.norm * (1 + 1e-9)) + 1)
    digits: list[np.ndarray] = []
    score = np.zeros((len(a.values), len(b.values)), dtype=np.int64)
    place = 1
    for k, p in enumerate(primes):
        x, y = a.modulo(p), b.modulo(p)
        rest = np.zeros(score.shape)
        for c in range(0, x.shape[1], WIDTH):
            rest += x[:, c : c + WIDTH] @ y[:, c : c + WIDTH].T
        rest = _around_zero(rest, p)
        for earlier, q in zip(digits, primes[:k], strict=True):
            rest = _around_zero((rest - earlier) * pow(q, -1, p), p)
        digits.append(rest)
        # a place beyond 64 bits wraps, and so does the sum, which ends where the true score is
        wrapped = (place + 2**63) % 2**64 - 2**63
        score += rest.astype(np.int64) * np.int64(wrapped)
        place *= p
    return score


def _whole(batch: pa.RecordBatch, rows: np.ndarray, scale: float, width: int) -> np.ndarray:
    """``floor(scale * x)`` of the chosen rows' vectors, as wide as asked: cut, or filled with zeros."""
    column = batch.column("vector").take(pa.array(rows))
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and np.abs(flat).max() >= 2.0**62:
        raise OverflowError("scores don't fit 64 bits")
    if len(sizes) and (sizes == width).all():
        return flat.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


class Selection:
    """The best ``keep`` rows of every (anchor, window) so far: higher scores first, ties by smaller id, null ids last."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, keep: int):
        self.lows, self.highs, self.keep = lows, highs, keep
        self.floor = lows.copy()
        self.best = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)]

    def add(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        windows = self.lows.shape[1]
        parts = [[x] for x in self.best]
        for w in range(windows):
            row, col = np.nonzero(allowed & (scores >= self.floor[:, w, None]) & (scores <= self.highs[:, w, None]))
            for part, new in zip(parts, (row * windows + w, scores[row, col], no_id[col], ids[col]), strict=True):
                part.append(new)
        key, score, nameless, name = (np.concatenate(p) for p in parts)
        order = np.lexsort((name, nameless, ~score, key))
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        order, last = order[rank < self.keep], order[rank == self.keep - 1]
        full = key[rank == self.keep - 1]
        self.best = [np.concatenate(p)[order] for p in parts]
        self.floor[full // windows, full % windows] = score[last]


def _select(batches: Iterator[pa.RecordBatch], scale: float, keep: int, same: bool, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """One task: anchors come first and stay, all other rows stream past them."""
    held: list[pa.RecordBatch] = []
    selection = block = None
    step = 64
    for batch in batches:
        is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
        if not is_row.all():
            held.append(batch.filter(pa.array(~is_row)))
        rows = np.flatnonzero(is_row)
        if not len(rows) or not held:
            continue
        if selection is None:
            anchors = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sizes = anchors.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            width = int(sizes.max())
            block = Residues(_whole(anchors, np.arange(len(anchors)), scale, width))
            label, own, no_own = _numbers(anchors, "label"), _numbers(anchors, "id"), _missing(anchors, "id")
            if same:
                lows, highs = np.full((len(anchors), 1), _LEAST), np.full((len(anchors), 1), _MOST)
            else:
                positives = anchors.column("scores")
                most = int(positives.value_lengths().to_numpy(zero_copy_only=False).max())
                score, at = positives.flatten().to_numpy(zero_copy_only=False), positives.offsets.to_numpy()
                lows, highs = np.full((len(anchors), most), 1, dtype=np.int64), np.zeros((len(anchors), most), dtype=np.int64)
                row = np.repeat(np.arange(len(anchors)), np.diff(at))
                col = np.arange(len(score)) - (at[:-1] - at[0])[row]
                hundreds, rest = np.divmod(score, 100)
                lows[row, col], highs[row, col] = low * hundreds - (-low * rest) // 100, high * hundreds + high * rest // 100
            selection = Selection(lows, highs, keep)
        labels, ids, no_id = _numbers(batch, "label"), _numbers(batch, "id"), _missing(batch, "id")
        lo = 0
        while lo < len(rows):
            some = rows[lo : lo + min(step, max(1, CELLS // len(label)))]
            lo, step = lo + len(some), 2 * step
            scores = exact_scores(block, Residues(_whole(batch, some, scale, width)))
            allowed = (label[:, None] == labels[some]) == same
            if same:
                allowed &= (own[:, None] != ids[some]) | no_own[:, None] | no_id[some]
            selection.add(scores, allowed, ids[some], no_id[some])
    if selection is not None:
        key, score, nameless, name = selection.best
        windows = selection.lows.shape[1]
        yield pa.RecordBatch.from_pydict({
            "number": anchors.column("number").take(pa.array(key // windows)), "place": pa.array((key % windows).astype(np.int32)),
            "id": pa.array(name, mask=nameless), "score": pa.array(score),
        })


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)


def _missing(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).is_null().to_numpy(zero_copy_only=False)


def _pass(anchors: DataFrame, rows: DataFrame, blocks: int, slices: int, keep: int, scale: float, same: bool, low: int, high: int) -> DataFrame:
    """number, place, id, score of the best ``keep`` rows of each (anchor, window), ranked over all slices."""
    held = anchors.select(F.pmod(F.xxhash64("number"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
                          F.lit(False).alias("is_row"), "number", "id", "label", "vector", "scores")
    passing = rows.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), F.pmod(F.xxhash64("id", "vector"), F.lit(slices)).cast("int").alias("slice"),
                          F.lit(True).alias("is_row"), F.lit(None).cast("bigint").alias("number"), "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("scores"))
    dealt = held.unionByName(passing).repartitionById(blocks * slices, (F.col("block") * slices + F.col("slice")).cast("int")).sortWithinPartitions("is_row")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _select(batches, scale, keep, same, low, high)

    found = dealt.drop("block", "slice").mapInArrow(compute, "number bigint, place int, id bigint, score bigint")
    order = Window.partitionBy("number", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   anchor_block: int = ANCHOR_BLOCK, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``anchor`` marks.

    Components become ``floor(scale * x)``; a score is the inner product of two rows. An anchor's positives are the first
    ``positives`` rows of its label with another id; for each of them the first ``negatives`` rows of other labels with
    ``low * positive <= 100 * negative <= high * positive`` are returned. Higher scores come first, ties by smaller id.

    Rows with a null label, a null vector or a null or non-finite component take no part. A shorter vector counts as
    filled with zeros. Ids and labels are integers; a null id is an id unlike any other and comes last among ties. Repeated
    rows are each a candidate and each an anchor, under the same id. Scores beyond 64 bits raise ``OverflowError``. A table
    without anchors gives no rows; other columns are not read.

    Memory of a task: ``anchor_block`` anchors and a batch of rows. Work grows with anchors times rows, dealt over as many
    tasks as blocks times slices.
    """
    spark = rows.sparkSession
    usable = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = usable.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)
    anchors = usable.filter("is_anchor").select(F.monotonically_increasing_id().alias("number"), "id", "label", "vector")
    anchors = stored(anchors, "anchors")
    size = usable.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).first()
    blocks = max(1, -(-size.a // anchor_block))
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks, -(-size.n // slice_rows), 1)
    usable = usable.drop("is_anchor")

    near = _pass(anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), usable, blocks, slices, positives, scale, True, low, high)
    near = near.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    near = stored(near, "positives")
    anchors = stored(anchors.join(near, "number").withColumn("scores", F.col("near.score")), "windows")
    far = _pass(anchors, usable, blocks, slices, negatives, scale, False, low, high)
    chosen = F.col("near")[F.col("place")]
    return far.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(anchors.select("number", "id", "near"), "number").select(
        F.col("id").alias("anchor_id"), chosen["id"].alias("positive_id"), "rank", "negative_id", chosen["score"].alias("positive_score"), "negative_score",
    )
