"""Near-duplicate passages between documents, by compact windows.

A text is a sequence of word shingles. For each of a few hash functions the Cartesian tree over the shingles' hashes groups all
passages of ``width`` words or more that share their minimum into compact windows (left, minimum, right): about two
windows for every ``width`` shingles. Windows of different documents with the same minimum meet in a join; passages for
which enough functions agree are fetched and verified on their whole shingle sets.

A minimum that many documents share first links each of them with the one of the smallest id. Windows whose minimum is in
no passage verified that way then meet all other holders of smaller id: equal stretches around the minimum are settled by
one grouping, and of the different ones that are left each is sent once, cut to a few hundred shingles, and compared in
blocks inside tasks. Texts and pairs are not shuffled for it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import BROADCAST_ROWS, id_and_text, schema_with, small_side, stored

WIDTH = 50
SHINGLE = 5
FUNCTIONS = 5
AGREE = 2
SIMILARITY = 0.8
#: shingles without counterpart that a passage may have in a row, about two changed words
MAX_GAP = 2 * SHINGLE + 2
#: places that are looked up together when runs are chained, twice the gap at least
BIN = 32
#: pairs of equal shingles of two texts that are chained at a time
PAIRS = 200_000
#: functions whose minima bring the rest together, without a second one having to agree: 1 - 0.2 ** 3 = 0.992
DIRECT = 3
#: stretches on either side of a minimum that are compared for it, in shortest passages
REACH = 2
#: stretches of one minimum that are compared in a task
BLOCK = 2048
#: stretches that are compared at once without looking for those with rare shingles first
FEW = 64


def nearest_smaller(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the next smaller key to the left (-1: none in the row) and to the right (len: none).

    These are the edges of the Cartesian tree. Every entry starts at its neighbour and jumps on over what its
    neighbour has already passed, so few rounds do.
    """
    n = len(keys)

    def one_way(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
        left = np.arange(-1, n - 1)
        left[(left >= 0) & (row[left] != row)] = -1
        open_ = np.flatnonzero(left >= 0)
        while len(open_):
            open_ = open_[keys[left[open_]] > keys[open_]]
            left[open_] = left[left[open_]]
            open_ = open_[left[open_] >= 0]
        return left

    right = one_way(keys[::-1], row[::-1])[::-1]
    return one_way(keys, row), np.where(right < 0, n, n - 1 - right)


def compact_windows(value: np.ndarray, row: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, left, right) of the windows of ``span`` shingles or more, as positions in the chunk; ``row`` is sorted.

    The first of equal values counts as the smallest. Only minima of some run of exactly ``span`` shingles can have such
    windows, and with a shingle its smaller neighbours in the tree are among those too.
    """
    n = len(value)
    if n < span:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    key = (value & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    low, size = key, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = span - size
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    low = low[row[: n - span + 1] == row[span - 1 :]]
    if not len(low):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    low = low[np.concatenate([[True], low[1:] != low[:-1]])]
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    before, after = nearest_smaller(low, row[at])
    first = np.searchsorted(row, row[at], side="left")
    last = np.searchsorted(row, row[at], side="right") - 1
    left = np.where(before >= 0, at[before] + 1, first)
    right = np.where(after < len(at), at[np.minimum(after, len(at) - 1)] - 1, last)
    return at, left, right


def windows(docs: DataFrame, width: int, shingle: int, functions: int) -> DataFrame:
    """key (function and shingle), doc_id, low, high, at, same: compact windows as ranges of shingles of their document, and the minimum's place.

    ``same`` is equal where the shingles of the window within reach of the minimum are; it is 0 for functions beyond DIRECT.
    """
    span = width - shingle + 1

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = _flips(functions)
        for part, texts in tx.chunks(batches, "text"):
            words = texts.words(tx.SPACED, lower=True)
            position, value = words.grams(shingle)
            row = words.row[position]
            start = words.bounds[row]
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(tx.mix(value ^ np.uint64(0xA24BAED4963EE407)), dtype=np.uint64)])
            for f in range(functions):
                mapped = tx.mix(value ^ flips[f])
                at, left, right = compact_windows(mapped, row, span)
                # a shingle that comes again inside its own window, as in repeated words, makes one window
                again = np.zeros(len(at), dtype=bool)
                again[1:] = (value[at[1:]] == value[at[:-1]]) & (row[at[1:]] == row[at[:-1]]) & (left[1:] <= right[:-1] + 1)
                begin = np.flatnonzero(~again)
                if not len(begin):
                    continue
                high = np.maximum.reduceat(right, begin)
                at, low = at[begin], left[begin]
                same = np.zeros(len(at), dtype=np.uint64)
                if f < DIRECT:
                    same = total[np.minimum(high, at + REACH * span) + 1] - total[np.maximum(low, at - REACH * span)]
                places = [pa.array((position[x] - start[at]).astype(np.int32)) for x in (low, high, at)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_key(mapped[at], f)), part.column("doc_id").take(pa.array(row[at])), *places, pa.array(tx.signed(same))],
                    names=["key", "doc_id", "low", "high", "at", "same"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(compute, f"key bigint, doc_id {kind}, low int, high int, at int, same bigint")


def _flips(functions: int) -> np.ndarray:
    return np.random.default_rng(20231105).integers(0, 1 << 63, functions, dtype=np.uint64)


def _key(mapped: np.ndarray, f: int | np.ndarray) -> np.ndarray:
    return (tx.signed(mapped) & ~np.int64(15)) | np.int64(f)


def agreed_ranges(low: np.ndarray, high: np.ndarray, function: np.ndarray, agree: int) -> list[tuple[int, int]]:
    """Ranges (both ends included) that lie in windows of at least ``agree`` functions."""
    points, change = [], []
    for f in np.unique(function):
        mine = function == f
        order = np.argsort(low[mine], kind="stable")
        a, b = low[mine][order], np.maximum.accumulate(high[mine][order])
        opens = np.concatenate([[True], a[1:] > b[:-1] + 1])
        begin = np.flatnonzero(opens)
        points += [a[begin], b[np.append(begin[1:] - 1, len(b) - 1)] + 1]
        change += [np.ones(len(begin), dtype=np.int64), -np.ones(len(begin), dtype=np.int64)]
    at, step = np.concatenate(points), np.concatenate(change)
    order = np.argsort(at, kind="stable")
    at, depth = at[order], np.cumsum(step[order])
    final = np.append(at[1:] > at[:-1], True)
    at, enough = at[final], depth[final] >= agree
    opens = np.flatnonzero(enough & ~np.concatenate([[False], enough[:-1]]))
    closes = np.flatnonzero(~enough & np.concatenate([[False], enough[:-1]]))
    return [(int(at[a]), int(at[b]) - 1) for a, b in zip(opens, closes, strict=True)]


class Places(NamedTuple):
    """The shingles of a text or a part of it, sorted.

    ``order`` are the places by shingle, ``ordered`` the shingles there, ``before`` the place before each one that has the same
    shingle (-1: none), or None where all shingles differ.
    """

    order: np.ndarray
    ordered: np.ndarray
    before: np.ndarray | None

    @classmethod
    def of(cls, shingles: np.ndarray) -> Places:
        order = np.argsort(shingles, kind="stable")
        ordered = shingles[order]
        again = np.flatnonzero(ordered[1:] == ordered[:-1])
        if not len(again):
            return cls(order, ordered, None)
        before = np.full(len(order), -1)
        before[order[again + 1]] = order[again]
        return cls(order, ordered, before)

    def find(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some shingles where its places start and end in ``order``."""
        first = np.searchsorted(self.ordered, shingles)
        if self.before is not None:
            return first, np.searchsorted(self.ordered, shingles, side="right")
        if not len(self.ordered):
            return first, first
        return first, first + (self.ordered[np.minimum(first, len(self.ordered) - 1)] == shingles)

    def repeats(self) -> np.ndarray | int:
        """How often the shingle of each place stands there."""
        if self.before is None:
            return 1
        times = np.diff(np.flatnonzero(np.concatenate([[True], self.ordered[1:] != self.ordered[:-1], [True]])))
        repeats = np.empty(len(self.order), dtype=np.int64)
        repeats[self.order] = np.repeat(times, times)
        return repeats


def counterparts(first: np.ndarray, times: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text whose shingles the other text has too, and the place each of them maps to there.

    The shingle of each place has the places ``order[first : first + times]`` in the other text. Of several the one on the longest
    chain counts: runs of consecutive shingles are chained over short gaps in both texts. Shingles that are so frequent
    that all their pairs would exceed ``PAIRS`` take the place nearest to that of the chosen ones around them.
    """
    here = np.flatnonzero(times)
    first, times = first[here], times[here]
    there = order[first]
    if not len(here) or times.max() == 1:
        return here, there
    rare = np.argsort(times, kind="stable")
    rare = np.sort(rare[np.cumsum(times[rare]) <= max(PAIRS, 2 * len(here))])
    known = np.zeros(len(here), dtype=bool)
    if len(rare):
        known[rare] = True
        n = times[rare]
        ends = np.cumsum(n)
        y = order[np.repeat(first[rare] - ends + n, n) + np.arange(ends[-1])]
        # by diagonal, and along it
        wide, high = int(here[-1]) + 1, len(order)
        diagonal, x = np.divmod(np.sort((y - np.repeat(here[rare], n) + wide) * wide + np.repeat(here[rare], n)), wide)
        y = diagonal - wide + x
        opens = np.flatnonzero(np.concatenate([[True], (np.diff(diagonal) != 0) | (np.diff(x) != 1)]))
        closes = np.append(opens[1:], len(x)) - 1
        total = _chained(x[opens], x[closes], y[opens], y[closes])
        # the longest chain, and the smallest place of equal ones
        best = np.zeros(wide, dtype=np.int64)
        np.maximum.at(best, x, np.repeat(total, closes - opens + 1) * high + (high - 1 - y))
        there[rare] = high - 1 - best[here[rare]] % high
    sure = np.flatnonzero(known)
    for k in np.flatnonzero(~known).tolist():
        at = int(np.searchsorted(sure, k))
        near = [int(sure[j]) for j in (at - 1, at) if 0 <= j < len(sure)]
        if k and not near:
            near = [k - 1]
        if near:
            by_it = min(near, key=lambda j: abs(int(here[j]) - int(here[k])))
            places = order[first[k] : first[k] + times[k]]
            there[k] = places[np.argmin(np.abs(places - (there[by_it] + here[k] - here[by_it])))]
    return here, there


def _chained(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Shingles on the longest chain through each run (x0..x1 in one text, y0..y1 in the other, ends included)."""

    def one_way(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> np.ndarray:
        score = (x1 - x0 + 1).tolist()
        for before, after in _following(x0, x1, y0, y1):
            more = x1[after] - np.maximum(x1[before], x0[after] - 1)
            for m, k, gain in zip(before.tolist(), after.tolist(), more.tolist(), strict=True):
                if score[m] + gain > score[k]:
                    score[k] = score[m] + gain
        return np.array(score)

    return one_way(x0, x1, y0, y1) + one_way(-x1, -x0, -y1, -y0) - (x1 - x0 + 1)


def _following(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of runs of which the second goes on from the first, over gaps of up to ``MAX_GAP`` in both texts; by the second's ``x0``, some at a time."""
    # runs by where they end: two neighbouring bins of the other text hold all that a run can follow
    left, wide = int(x0.min()), int(x1.max() - x0.min()) + 1
    ending = y1 // BIN * wide + x1 - left
    order = np.argsort(ending)
    ending = ending[order]
    runs = np.argsort(x0, kind="stable")
    bins = np.stack([(y0[runs] - MAX_GAP - 1) // BIN, (y0[runs] + MAX_GAP - 1) // BIN], axis=1) * wide
    begin = np.searchsorted(ending, bins + np.maximum(x0[runs] - MAX_GAP - 1 - left, 0)[:, None])
    n = np.searchsorted(ending, bins + (x1[runs] - left)[:, None]) - begin
    n[bins[:, 0] == bins[:, 1], 1] = 0
    ends = np.concatenate([[0], np.cumsum(n.sum(axis=1))])
    done = 0
    while done < len(runs):
        stop = max(done + 1, int(np.searchsorted(ends, ends[done] + PAIRS, side="right")) - 1)
        some, from_ = n[done:stop].ravel(), begin[done:stop].ravel()
        after = np.repeat(runs[done:stop], n[done:stop].sum(axis=1))
        before = order[np.repeat(from_ - np.cumsum(some) + some, some) + np.arange(len(after))]
        gap = y0[after] - y1[before] - 1
        good = (gap >= -MAX_GAP) & (gap <= MAX_GAP) & (x0[before] < x0[after]) & (y0[before] < y0[after]) & (y1[before] < y1[after])
        yield before[good], after[good]
        done = stop


def may_hold(member: np.ndarray, repeats: np.ndarray, span: int, similarity: float, through: int | None = None) -> np.ndarray:
    """Which rows of ``member`` (shingles of a text that another one has) leave room for a passage, through a given place if any.

    Of a passage's different shingles the wanted share is in the other text. The shingle of each place stands ``repeats`` times in
    the row, so one that the other text lacks counts for a part of that at each: no row that has a passage is ruled out.
    """
    return _best_score(member, 1 - similarity, similarity / repeats, span, through) >= -1e-9


def _best_score(member: np.ndarray, gain: float, loss: np.ndarray, span: int, through: int | None = None) -> np.ndarray:
    """Highest sum over ``span`` places or more of each row (those through a given place), of gains for members and losses for others."""
    n = member.shape[1]
    if n < span:
        return np.full(len(member), -np.inf)
    score = np.zeros((len(member), n + 1))
    np.cumsum(np.where(member, gain, -loss), axis=1, out=score[:, 1:])
    if through is None:
        return (score[:, span:] - np.minimum.accumulate(score[:, : n + 1 - span], axis=1)).max(axis=1)
    best = np.minimum.accumulate(score[:, : through + 1], axis=1)
    stop = np.arange(max(span, through + 1), n + 1)
    return (score[:, stop] - best[:, np.minimum(stop - span, through)]).max(axis=1)


def least_shared(repeats: np.ndarray, span: int, similarity: float, through: int) -> int:
    """Different shingles that a passage through a place has in common with its partner at least; ``repeats`` as in :func:`may_hold`."""
    total = np.concatenate([[0.0], np.cumsum(1 / repeats)])
    first = np.arange(max(0, through - span + 1), min(through, len(repeats) - span) + 1)
    different = (total[first + span] - total[first]).min(initial=span)
    return max(1, math.ceil(similarity * different - 1e-9))


def passages(mine: np.ndarray, theirs: np.ndarray, ranges: list[tuple[int, int]], span: int, similarity: float,
             index: Places | None = None, through: int | None = None) -> list[tuple[int, int, int, int, float]]:
    """Verified passages: (first, last, their first, their last, Jaccard similarity), in shingles, ends included.

    Shingles with a counterpart are chained over short gaps. A chain is a passage if its shingle set and that of the
    stretch it maps to are similar enough; otherwise it is cut where it jumps most, and both parts are tried. ``index`` has
    ``theirs`` sorted. Only passages through a given place of ``mine`` are looked for, if one is given.
    """
    index = Places.of(theirs) if index is None else index
    found = []
    for low, high in ranges:
        if through is not None and not low <= through <= high:
            continue
        part = mine[low : high + 1]
        own = Places.of(part)
        begin, stop = index.find(own.ordered)
        first, times = np.empty_like(begin), np.empty_like(begin)
        first[own.order], times[own.order] = begin, stop - begin
        member = times > 0
        at = np.flatnonzero(member)
        if not len(at):
            continue
        # a passage begins and ends with shingles that the other text has, and goes over no long gap
        cut = np.flatnonzero(np.diff(at) > MAX_GAP) + 1
        loss = np.full(len(part), similarity) / own.repeats()
        ahead, behind = np.append(at[0], at[cut]) - 1, np.append(at[cut - 1], at[-1]) + 1
        loss[ahead[ahead >= 0]] = loss[behind[behind < len(part)]] = len(part) + 1
        if _best_score(member[None], 1 - similarity, loss, span, None if through is None else through - low)[0] < -1e-9:
            continue
        here, there = counterparts(first, times, index.order)
        some = _fitting(here, there, own.before, index.before, span, similarity, None if through is None else through - low)
        found += [(first + low, last + low, *rest) for first, last, *rest in some]
    return sorted(found)


def _fitting(here: np.ndarray, there: np.ndarray, own: np.ndarray | None, other: np.ndarray | None, span: int, similarity: float,
             through: int | None) -> list[tuple[int, int, int, int, float]]:
    """The chains ``here`` is cut into that are similar enough to what they map to; ``own`` and ``other`` as in ``Places.before``."""

    def different(before: np.ndarray | None, first: int, last: int) -> int:
        return last - first + 1 if before is None else int(np.count_nonzero(before[first : last + 1] < first))

    found = []
    steps = np.diff(here)
    jumps = np.abs(np.diff(there) - 1) + steps - 1
    edges = [0, *(np.flatnonzero(steps > MAX_GAP) + 1).tolist(), len(here)]
    todo = [(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    while todo:
        a, b = todo.pop()
        first, last = int(here[a]), int(here[b - 1])
        if last - first + 1 < span or through is not None and not first <= through <= last:
            continue
        lo, hi = int(there[a:b].min()), int(there[a:b].max())
        if hi - lo + 1 <= 4 * (last - first + 1):
            # all shingles of the chain are in the stretch it maps to, and the others nowhere
            shared = b - a if own is None else int(np.count_nonzero(own[here[a:b]] < first))
            score = shared / (different(own, first, last) + different(other, lo, hi) - shared)
            if score >= similarity:
                found.append((first, last, lo, hi, score))
                continue
        k = int(np.argmax(jumps[a : b - 1])) if b - a > 1 else 0
        if b - a == 1 or jumps[a + k] == 0:
            continue
        todo += [(a, a + k + 1), (a + k + 1, b)]
    return found


def _shingles(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, shingles: the hashes of all shingles in order, 32 bits of each (they are compared within two documents only)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            words = texts.words(tx.SPACED, lower=True)
            position, value = words.grams(shingle)
            bounds = np.searchsorted(words.row[position], np.arange(texts.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), pa.array((value >> np.uint64(32)).astype(np.uint32).view(np.int32)))], names=["doc_id", "shingles"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(compute, f"doc_id {kind}, shingles array<int>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, shingle: int = SHINGLE,
                      functions: int = FUNCTIONS, agree: int = AGREE, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of ``width`` words or more that near-repeat a passage of a document with a smaller id.

    Rows: doc_id, start, end (words, end excluded), source_doc_id, source_start, source_end, similarity. Words are runs
    of anything but ASCII white space, A-Z lower-cased; similarity is that of the sets of word shingles. Null ids, null,
    empty and shorter texts give no rows. Rows that repeat a doc_id are taken as one document's alternatives and are
    not compared with one another; nor are passages within one document. A repeat among many documents is reported once
    for each of them but the first; where parts of it meet different documents first, its rows may overlap.
    """
    docs = id_and_text(docs, id_col, text_col).filter("doc_id is not null")
    span = width - shingle + 1
    # most windows are met once only: they are shuffled once and not stored
    holders = Window.partitionBy("key")
    found = windows(docs, width, shingle, functions).withColumn("lead", F.min("doc_id").over(holders)).withColumn("other", F.max("doc_id").over(holders))
    shared = stored(found.filter("lead != other").drop("other"), "shared-windows")
    pairs = _agreeing(shared.filter("doc_id != lead"), agree, span)
    verified = stored(_verified(docs, pairs, span, shingle, similarity), "verified")

    # what no passage covers meets every holder of its key, the lead too: two keys of a pair may have had different leads
    unsettled = stored(_unsettled(shared, verified, shingle), "unsettled")
    return verified.union(_among_holders(docs, shared, unsettled, span, shingle, similarity))


def _agreeing(hits: DataFrame, agree: int, span: int) -> DataFrame:
    """doc_id, lead, ranges (low, high) of ``span`` shingles or more in which windows of at least ``agree`` functions meet."""
    pairs = hits.groupBy("doc_id", "lead").agg(
        F.collect_list(F.struct("low", "high", F.col("key").bitwiseAND(15).cast("int").alias("f"))).alias("windows"),
        F.bit_or(F.expr("shiftleft(1, cast(key & 15 as int))")).alias("mask"),
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met, rows, found, ends = batch.column("windows"), [], [], [0]
            ends_met = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(met)))])
            low, high, f = (np.asarray(met.flatten().field(c)) for c in ("low", "high", "f"))
            for k in range(batch.num_rows):
                own = slice(ends_met[k], ends_met[k + 1])
                agreed = [r for r in agreed_ranges(low[own], high[own], f[own], agree) if r[1] - r[0] + 1 >= span]
                if agreed:
                    rows.append(k)
                    found += agreed
                    ends.append(len(found))
            take, found = pa.array(rows, pa.int64()), np.array(found, dtype=np.int32).reshape(-1, 2)
            ranges = pa.StructArray.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["low", "high"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("lead").take(take), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ranges)],
                names=["doc_id", "lead", "ranges"])

    kind = dict(hits.dtypes)["doc_id"]
    agreeing = pairs.filter(F.bit_count("mask") >= agree).select("doc_id", "lead", "windows")
    return stored(agreeing.mapInArrow(compute, f"doc_id {kind}, lead {kind}, ranges array<struct<low: int, high: int>>"), "pairs")


def _unsettled(shared: DataFrame, verified: DataFrame, shingle: int) -> DataFrame:
    """key, doc_id, at, same of the windows whose minimum lies in no verified passage of their document."""
    spans = stored(verified.groupBy("doc_id").agg(F.collect_set(F.struct("start", (F.col("end") - shingle).alias("last"))).alias("spans")), "settled")
    joined = shared.filter("doc_id != lead").join(small_side(spans, 100_000), "doc_id", "left")
    covered = F.exists("spans", lambda p: (p["start"] <= F.col("at")) & (F.col("at") <= p["last"]))
    return joined.filter(F.col("spans").isNull() | ~covered).select("key", "doc_id", "at", "same")


def _among_holders(docs: DataFrame, shared: DataFrame, unsettled: DataFrame, span: int, shingle: int, similarity: float) -> DataFrame:
    """Passages around the minima of ``unsettled`` windows, each with the first holder of its key that has it."""
    reach = REACH * span
    unsettled = unsettled.filter(F.col("key").bitwiseAND(15) < DIRECT)
    keys = stored(unsettled.select("key").distinct(), "unsettled-keys")
    place = F.struct("doc_id", "at", F.greatest("low", F.col("at") - reach).alias("start"), F.least("high", F.col("at") + reach).alias("last"))
    held = shared.join(small_side(keys), "key", "left_semi").select("key", "same", place.alias("p"))
    # equal stretches: the first holder stands for all
    first = stored(held.groupBy("key", "same").agg(F.min("p").alias("p")), "stretches")
    equal = unsettled.join(first, ["key", "same"]).filter("doc_id > p.doc_id")
    moved = F.col("at") - F.col("p.at")
    equal = equal.select("doc_id", (F.col("p.start") + moved).cast("bigint").alias("start"), (F.col("p.last") + moved + shingle).cast("bigint").alias("end"),
                         F.col("p.doc_id").alias("source_doc_id"), F.col("p.start").cast("bigint").alias("source_start"),
                         (F.col("p.last") + shingle).cast("bigint").alias("source_end"), F.lit(1.0).alias("similarity"))

    # different stretches of a key: those of unsettled windows look for one that is similar
    opened = unsettled.select("key", "same", "doc_id", "at").distinct().withColumn("open", F.lit(True))
    marked = first.select("key", "same", "p.*").join(opened, ["key", "same", "doc_id", "at"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    sizes = marked.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("any")).filter("n > 1 and any")
    sizes = stored(sizes.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "stretch-keys")
    wanted = marked.join(small_side(sizes), "key").withColumn("block", F.pmod(F.xxhash64("doc_id", "same"), "blocks").cast("int"))
    stretches = _stretches(docs, wanted.select("doc_id", "key", "at", "start", "last", "open", "block", "blocks"), shingle)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = stretches.withColumn("other", other).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "at", "start", "open", "block", "shingles")
    cells = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc_id", "at")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"key bigint, at int, doc_id {kind}, start bigint, end bigint, source_doc_id {kind}, source_start bigint, source_end bigint, similarity double"
    similar = cells.mapInArrow(_meeting(span, shingle, similarity), schema)
    source = F.struct("source_doc_id", "source_start", "source_end", "start", "end", "similarity")
    similar = similar.groupBy("key", "doc_id", "at").agg(F.min(source).alias("s")).select("doc_id", "s.*").select(*equal.columns)
    return _joined(equal.union(similar).distinct())


def _joined(found: DataFrame) -> DataFrame:
    """Overlapping passages with the same source, moved alike, as one; its similarity is the least of theirs."""
    pair = Window.partitionBy("doc_id", "source_doc_id").orderBy("start", "end", "source_start", "source_end")
    before = pair.rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.max("end").over(before).isNull() | (F.col("start") >= F.max("end").over(before)) | ~F.col("source_start").between(
        F.lag("source_start").over(pair), F.lag("source_end").over(pair))
    island = found.withColumn("fresh", fresh.cast("int")).withColumn("island", F.sum("fresh").over(pair.rowsBetween(Window.unboundedPreceding, 0)))
    merged = island.groupBy("doc_id", "source_doc_id", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("source_start").alias("source_start"),
        F.max("source_end").alias("source_end"), F.min("similarity").alias("similarity"))
    return merged.select("doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "similarity")


def _stretches(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """The rows of ``wanted`` with the hashes of their shingles, 32 bits of each, taken again from the texts."""
    fields = ["key", "at", "start", "last", "open", "block", "blocks"]
    wanted = stored(wanted, "wanted-stretches")
    listed = wanted.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    # counted by stretches, not by documents: they bound the bytes
    listed = F.broadcast(listed) if wanted.count() <= BROADCAST_ROWS else listed
    flips = _flips(DIRECT)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            words = texts.words(tx.SPACED, lower=True)
            position, value = words.grams(shingle)
            bounds = np.searchsorted(words.row[position], np.arange(texts.n + 1))
            lists = part.column("wanted")
            row = np.repeat(np.arange(texts.n), np.asarray(pc.list_value_length(lists)))
            asked = lists.flatten()
            key, at, start, last = (np.asarray(asked.field(c)) for c in fields[:4])
            # a doc_id may stand for several texts; a stretch belongs to the one that has its minimum there
            here = np.flatnonzero(last < (bounds[row + 1] - bounds[row]))
            place = value[bounds[row[here]] + at[here]]
            f = key[here] & 15
            here = here[_key(tx.mix(place ^ flips[f]), f) == key[here]]
            begin, size = bounds[row[here]] + start[here], (last - start + 1)[here].astype(np.int64)
            ends = np.cumsum(size)
            flat = np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
            short = (value[flat] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(short))
            take = pa.array(here)
            columns = [part.column("doc_id").take(pa.array(row[here])), *(asked.field(c).take(take) for c in fields if c != "last"), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(c for c in fields if c != "last"), "shingles"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, key bigint, at int, start int, open boolean, block int, blocks int, shingles array<int>"
    return docs.join(listed, "doc_id").mapInArrow(compute, schema)


def _meeting(span: int, shingle: int, similarity: float):
    """For sorted rows of cells: the passages around the minima of open rows, each with the first row of a smaller doc_id that has it."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of whole cells."""
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [np.asarray(batch.column(c)) for c in ("key", "i", "j")]
            change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1
            head = waiting and any(w.column(c)[w.num_rows - 1].as_py() != batch.column(c)[0].as_py() for w in waiting[-1:] for c in ("key", "i", "j"))
            if head:
                yield pa.Table.from_batches(waiting)
                waiting = []
            if len(change):
                cut = int(change[-1])
                yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
                waiting = []
                batch = batch.slice(cut)
            waiting.append(batch)
        if waiting:
            yield pa.Table.from_batches(waiting)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in cells(batches):
            batch = table.combine_chunks().to_batches()[0]
            ids = batch.column("doc_id")
            key, i, j, at, start, block = (np.asarray(batch.column(c)) for c in ("key", "i", "j", "at", "start", "block"))
            opens = np.asarray(batch.column("open").to_numpy(zero_copy_only=False))
            lists = batch.column("shingles")
            size = np.asarray(pc.list_value_length(lists)).astype(np.int64)
            flat = np.asarray(lists.flatten())
            offset = np.concatenate([[0], np.cumsum(size)])
            edge = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            cell = np.cumsum(edge) - 1
            same_id = np.asarray(pc.equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)).astype(bool)
            document = np.cumsum(edge | np.concatenate([[True], ~same_id]))
            bounds = np.append(np.flatnonzero(edge), len(key))
            rows, sources, spans, scores = [], [], [], []
            salted = (np.repeat(cell, size).astype(np.uint64) << np.uint64(32)) | flat.view(np.uint32)
            order = np.argsort(salted, kind="stable")
            fresh = np.concatenate([[True], np.diff(salted[order]) != 0])
            times = np.diff(np.append(np.flatnonzero(fresh), len(order)))
            code = np.empty(len(order), dtype=np.int64)
            code[order] = np.cumsum(fresh) - 1
            elsewhere = (times > 1)[code]
            holder = np.repeat(np.arange(len(size)), size)[order]
            # how often its row has each place's shingle
            often = np.ones(len(flat), dtype=np.int64)
            opening = np.flatnonzero(np.concatenate([[True], (np.diff(code[order]) != 0) | (np.diff(holder) != 0)]))
            times_there = np.diff(np.append(opening, len(order)))
            often[order] = np.repeat(times_there, times_there)
            posted = np.concatenate([[0], np.cumsum(times)])
            flag = np.zeros(len(times), dtype=np.int32)
            minimum = at - start
            low, high = bounds[cell], np.flatnonzero(np.diff(document, prepend=-1))[document - document[0]]
            plain = np.diff(np.concatenate([[0], np.cumsum(often)])[offset]) == size
            # shingles that no row of the cell has besides can't be shared
            asked = np.flatnonzero(opens & (low < high))
            asked = asked[_with_room(asked, elsewhere, often, offset, minimum, span, similarity)]
            for a in asked.tolist():
                own = slice(offset[a], offset[a + 1])
                least = least_shared(often[own], span, similarity, int(minimum[a])) if not plain[a] else max(1, math.ceil(similarity * span - 1e-9))
                others = np.arange(low[a], high[a])
                if len(others) > FEW:
                    # a partner shares so many that it has one of the rarest, all but one fewer than those
                    distinct = np.unique(code[own][elsewhere[own]])
                    rare = distinct[np.argsort(times[distinct], kind="stable")][: max(0, len(distinct) - least + 1)]
                    if not len(rare):
                        continue
                    others = np.unique(np.concatenate([holder[posted[c] : posted[c + 1]] for c in rare.tolist()]))
                    others = others[(others >= low[a]) & (others < high[a])]
                if i[a] != j[a]:
                    others = others[block[others] != block[a]]
                hit = _first_similar(a, others, code, flat, offset, flag, often, plain, int(minimum[a]), least, span, similarity)
                if hit is not None:
                    b, (first, last, lo, hi, score) = hit
                    rows.append(a)
                    sources.append(b)
                    spans.append((start[a] + first, start[a] + last + shingle, start[b] + lo, start[b] + hi + shingle))
                    scores.append(score)
            take, source = pa.array(rows, pa.int64()), pa.array(sources, pa.int64())
            spans = np.array(spans, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(take), batch.column("at").take(take), ids.take(take), pa.array(spans[:, 0]), pa.array(spans[:, 1]), ids.take(source), pa.array(spans[:, 2]), pa.array(spans[:, 3]), pa.array(scores, pa.float64())],
                names=["key", "at", "doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "similarity"],
            )

    return compute


def _with_room(rows: np.ndarray, member: np.ndarray, often: np.ndarray, offset: np.ndarray, minimum: np.ndarray, span: int, similarity: float) -> np.ndarray:
    """:func:`may_hold` for some rows of all the shingles, each through its minimum."""
    room = np.zeros(len(rows), dtype=bool)
    for done in range(0, len(rows), FEW):
        some = rows[done : done + FEW]
        before, size = minimum[some][:, None], (offset[some + 1] - offset[some])[:, None]
        through = int(before.max())
        # side by side with their minima in one column; no passage goes over what lies outside a row
        at = np.arange(through + int((size - before).max())) - through + before
        inside = (at >= 0) & (at < size)
        places = np.where(inside, offset[some][:, None] + at, 0)
        loss = np.where(inside, similarity / often[places], inside.shape[1] + 1)
        room[done : done + FEW] = _best_score(member[places] & inside, 1 - similarity, loss, span, through) >= -1e-9
    return room


def _first_similar(a: int, others: np.ndarray, code: np.ndarray, flat: np.ndarray, offset: np.ndarray, flag: np.ndarray, often: np.ndarray,
                   plain: np.ndarray, minimum: int, least: int, span: int, similarity: float) -> tuple[int, tuple[int, int, int, int, float]] | None:
    """The first of the rows ``others`` with a verified passage around the minimum of row ``a``, and that passage.

    Rows are ruled out, some at a time, by the number of their shingles that ``a`` has too (``least``) and by :func:`may_hold`, then one
    by one by what both sides lack: (1 - s) shared >= s (own + theirs), halved between the sides. The rest are verified. ``plain`` rows
    have no shingle twice.
    """
    own = code[offset[a] : offset[a + 1]]
    distinct, back = (own, slice(None)) if plain[a] else np.unique(own, return_inverse=True)
    repeats = often[offset[a] : offset[a + 1]]
    done, step = 0, 64
    while done < len(others):
        some = others[done : done + step]
        done, step = done + step, 4 * step
        sizes = offset[some + 1] - offset[some]
        ends = np.cumsum(sizes)
        places = np.repeat(offset[some] - ends + sizes, sizes) + np.arange(ends[-1])
        flag[distinct] = np.arange(1, len(distinct) + 1)
        theirs = flag[code[places]]
        flag[distinct] = 0
        met = np.flatnonzero(theirs)
        grid = np.zeros((len(some), len(distinct)), dtype=bool)
        grid[np.repeat(np.arange(len(some)), sizes)[met], theirs[met] - 1] = True
        near = np.flatnonzero(grid.sum(axis=1) >= least)
        if not len(near):
            continue
        near = near[may_hold(grid[near][:, back], repeats, span, similarity, minimum)]
        half = (1 - similarity) / 2
        ours = _best_score(grid[near][:, back], half, similarity / repeats, span, minimum) if len(near) else []
        mine = flat[offset[a] : offset[a + 1]]
        for k, so_far in zip(near.tolist(), ours, strict=True):
            b = int(some[k])
            there = theirs[ends[k] - sizes[k] : ends[k]] > 0
            if so_far + _best_score(there[None], half, similarity / often[offset[b] : offset[b + 1]], least)[0] < -1e-9:
                continue
            if plain[a] and plain[b]:
                # each shared shingle has one place on either side
                places_there = np.flatnonzero(there)
                here = theirs[ends[k] - sizes[k] : ends[k]][places_there] - 1
                by = np.argsort(here)
                found = _fitting(here[by], places_there[by], None, None, span, similarity, minimum)
            else:
                found = passages(mine, flat[offset[b] : offset[b + 1]], [(0, len(mine) - 1)], span, similarity, None, minimum)
            if found:
                return b, min(found)
    return None


def _verified(docs: DataFrame, pairs: DataFrame, span: int, shingle: int, similarity: float) -> DataFrame:
    """The passages of ``pairs`` that hold on whole shingle sets."""
    kind = dict(docs.dtypes)["doc_id"]
    leads = stored(pairs.select(F.col("lead").alias("doc_id")).distinct(), "leads")
    arrays = _shingles(docs.join(small_side(leads), "doc_id", "left_semi"), shingle).filter(F.size("shingles") >= span)
    listed = pairs.groupBy("doc_id").agg(F.collect_list(F.struct("lead", "ranges")).alias("pairs"))
    # counted by ranges, not by documents: they bound the bytes
    ranges = pairs.agg(F.sum(F.size("ranges"))).first()[0] or 0
    listed = F.broadcast(listed) if ranges <= BROADCAST_ROWS else listed

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text the ranges that agree with a partner, once for each of these."""
        for part, texts in tx.chunks(batches, "text"):
            words = texts.words(tx.SPACED, lower=True)
            position, value = words.grams(shingle)
            value = (value >> np.uint64(32)).astype(np.uint32).view(np.int32)
            bounds = np.searchsorted(words.row[position], np.arange(texts.n + 1))
            lists = part.column("pairs")
            row = np.repeat(np.arange(texts.n), np.asarray(pc.list_value_length(lists)))
            asked = lists.flatten()
            of, rows, lows, parts, ends = asked.field("ranges"), [], [], [], [0]
            ends_of = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(of)))]).tolist()
            lowest, highest = (np.asarray(of.flatten().field(c)).tolist() for c in ("low", "high"))
            for k, r in enumerate(row.tolist()):
                own = slice(ends_of[k], ends_of[k + 1])
                agreed = [(low, high) for low, high in zip(lowest[own], highest[own], strict=True) if bounds[r] + low < bounds[r + 1]]
                if agreed:
                    rows.append(k)
                    lows += [low for low, _ in agreed]
                    parts += [value[bounds[r] + low : min(bounds[r] + high + 1, bounds[r + 1])] for low, high in agreed]
                    ends.append(len(lows))
            sizes = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            inner = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))
            outer, take = pa.array(np.array(ends, dtype=np.int32)), pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row[rows].astype(np.int64))), asked.field("lead").take(take), pa.ListArray.from_arrays(outer, pa.array(lows, pa.int32())), pa.ListArray.from_arrays(outer, inner)],
                names=["doc_id", "lead", "lows", "mine"],
            )

    own = docs.join(listed, "doc_id").mapInArrow(pieces, f"doc_id {kind}, lead {kind}, lows array<int>, mine array<array<int>>")
    both = own.join(arrays.select(F.col("doc_id").alias("lead"), F.col("shingles").alias("theirs")), "lead")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            theirs, index = None, None
            lists, lows, parts = batch.column("theirs"), batch.column("lows"), batch.column("mine")
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lows)))]).tolist()
            lows, parts = np.asarray(lows.flatten()).tolist(), parts.flatten()
            sizes = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(parts)))]).tolist()
            ends_of = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))]).tolist()
            mines, others = np.asarray(parts.flatten()), np.asarray(lists.flatten())
            for k in range(batch.num_rows):
                other = others[ends_of[k] : ends_of[k + 1]]
                # rows of one lead mostly follow one another
                if theirs is None or not np.array_equal(other, theirs):
                    theirs, index = other, Places.of(other)
                for c in range(ends[k], ends[k + 1]):
                    mine, low = mines[sizes[c] : sizes[c + 1]], lows[c]
                    for first, last, *rest in passages(mine, theirs, [(0, len(mine) - 1)], span, similarity, index):
                        rows.append(k)
                        out.append((first + low, last + low, *rest))
            take = pa.array(rows, pa.int64())
            spans = np.array([p[:4] for p in out], dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), pa.array(spans[:, 0]), pa.array(spans[:, 1] + shingle), batch.column("lead").take(take), pa.array(spans[:, 2]), pa.array(spans[:, 3] + shingle), pa.array([p[4] for p in out], pa.float64())],
                names=["doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "similarity"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start bigint, end bigint, source_doc_id {kind}, source_start bigint, source_end bigint, similarity double"
    return both.select("doc_id", "lead", "lows", "mine", "theirs").mapInArrow(verify, schema).distinct()


def without_passages(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words of ``spans`` (doc_id, start, end) cut from their texts, and a column ``_cut`` with their number.

    White space before a cut passage stays, that behind it goes. Other columns are untouched.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("_cut", "_spans")])
    listed = stored(spans.groupBy(F.col("doc_id").alias(id_col)).agg(F.collect_set(F.struct("start", "end")).alias("_spans")), "cuts")
    names = docs.columns
    joined = docs.join(small_side(listed, 100_000), id_col, "left").select(*docs.columns, "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for part, texts in tx.chunks(batches, text_col):
            column, gone = part.column(text_col), np.zeros(texts.n, dtype=np.int64)
            marked = part.column("_spans")
            rows = np.flatnonzero(np.asarray(marked.is_valid()))
            if len(rows):
                words = texts.words(tx.SPACED, lower=True)
                out = column.to_pylist()
                raw = texts.data.tobytes()
                for k in rows.tolist():
                    first, size = int(words.bounds[k]), int(words.counts[k])
                    drop = np.zeros(size, dtype=bool)
                    for s in marked[k].as_py():
                        drop[s["start"] : s["end"]] = True
                    gone[k] = drop.sum()
                    start, end = int(texts.offsets[k]), int(texts.offsets[k + 1])
                    left = np.append(words.starts[first : first + size], end)
                    keep, pieces, pos = ~drop, [raw[start : int(left[0])]], 0
                    while pos < size:
                        stop = pos + 1
                        while stop < size and keep[stop] == keep[pos]:
                            stop += 1
                        if keep[pos]:
                            pieces.append(raw[int(left[pos]) : int(left[stop])])
                        pos = stop
                    out[k] = b"".join(pieces).decode()
                column = pa.array(out, column.type)
            columns = [part.column(c) for c in names]
            columns[at] = column
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone)], names=[*names, "_cut"])

    return joined.mapInArrow(cut, schema_with(docs, "_cut bigint"))
